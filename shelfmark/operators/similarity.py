"""Near-duplicate reviews.

For every review not processed yet: the lowest-numbered earlier review of the same work
and language whose length lies within a band and whose trigram similarity reaches a
threshold. The result is exact; all pairs of a group are never listed:

1. Reviews with the same text are one *class*, known by its lowest review id. Only
   classes are compared, and every copy but the first has an answer already.
2. Classes meet only inside (work, language) and a band of lengths. Blocks of bounded size
   are cut along the length, from counts alone; neighbouring blocks form a tile, and only
   tiles within reach of one that holds a review not processed yet are read.
3. Sets are built where the texts are read, if most are needed and the splits are even;
   otherwise texts are dealt out first.
4. A set moves packed: to its class, once to its block, where the sets become slices of
   lists of places, and with the block to the tasks that compare its tile with another one.
   There products of matrices give all shared trigrams of two slices within reach of each
   other at once. Groups of all sizes go this one way.

With a kept index (``pick_indexed``) a batch adds its own reviews and the trigram sets of
texts not met before, and reads, besides those, only sets of works with a pending review
and of a length such a review can be similar to.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from shelfmark.functions.text import trigrams
from shelfmark.operators.components import connected_components
from shelfmark.session import ship_package
from shelfmark.sources.tables import materialize, shuffle_files_dropped, spread

BUCKET_BASE = 1.3
# Not read any more: there are no leaders by min-hashes; the tests set it.
MINHASHES = 4
# Classes of a slice at least (where the block has them), of a block about, and blocks of a tile.
SMALL_GROUP = 256
BLOCK = 2048
BUNDLE = 4
# A trigram is rare between two blocks where it meets in fewer than one of so many pairs; trigrams a matrix
# and counted pairs at a time.
RARE = 200
SLICE = 4096
PAIRS = 4_000_000


@dataclass(frozen=True)
class SimilarityRules:
    """Fixed values of the job.

    ``radius`` is checked but not read: all classes are compared, none follows a leader.
    """

    min_similarity: float = 0.6
    min_length: int = 100
    length_delta: float = 0.08
    radius: float = 0.1

    def __post_init__(self):
        if self.min_similarity <= 2 * self.radius:
            raise ValueError("min_similarity must exceed twice the radius")
        if not 0 <= self.margin < 1:
            raise ValueError("length_delta must be below 1")

    @property
    def margin(self) -> float:
        """The length band with the most rounding can add."""
        return self.length_delta + 0.5 / max(self.min_length, 1)

    @property
    def reach(self) -> float:
        """Partners' lengths differ by this factor at most."""
        return math.exp(-math.log1p(-self.margin) * (1 + 1e-9))


class NothingPending(RuntimeError):
    """No work is left to compare."""


def enqueue_similarity(
    work: DataFrame,
    mapping: DataFrame,
    queue: DataFrame,
    reviews: DataFrame,
    n: int | None = None,
    sites: tuple[int, int] = (2, 4),
) -> DataFrame:
    """Reviews of the next ``n`` harvested works mapped on both sites and not queued yet.

    A work without reviews gives one row with review id -1 and length 0.
    """
    new = work.filter(F.col("last_harvest_dts").isNotNull()).select(F.col("refid").alias("work_refid"))
    for site in sites:
        on_site = mapping.filter(F.col("site_id") == site).select("work_refid")
        new = new.join(on_site, "work_refid", "left_semi")
    new = new.join(queue.select("work_refid"), "work_refid", "left_anti").distinct()
    if n is not None:
        new = new.orderBy("work_refid").limit(n)
    rows = reviews.select(
        "work_refid",
        F.col("id").alias("review_id"),
        F.length("review").alias("text_length"),
        "review_lang",
    )
    return new.join(rows, "work_refid", "left").select(
        "work_refid",
        F.coalesce("review_id", F.lit(-1).cast("long")).alias("review_id"),
        F.coalesce("text_length", F.lit(0)).alias("text_length"),
        "review_lang",
    )


def mark_processed(queue: DataFrame, processed_at: str) -> DataFrame:
    """Stamp everything still pending."""
    at = F.lit(processed_at).cast(queue.schema["date_processed"].dataType)
    return queue.withColumn("date_processed", F.coalesce("date_processed", at))


def in_band(length: Column, other_length: Column, delta: float) -> Column:
    """The review's length lies within the band around the other one's length."""
    width = F.round(other_length * delta)
    return (length >= other_length - width) & (length <= other_length + width)


def _bucket(length: Column) -> Column:
    return F.floor(F.log(length) / F.lit(math.log(BUCKET_BASE))).cast("int")


def _other_buckets(shortest: Column, longest: Column, margin: float) -> Column:
    """Buckets in which partners of texts between two lengths can lie."""
    low = F.floor(shortest / F.lit(1 + margin))
    high = F.ceil(longest / F.lit(1 - margin))
    return F.sequence(_bucket(F.greatest(low, F.lit(1))), _bucket(high))


def _step(df: DataFrame, name: str) -> DataFrame:
    """``materialize``, and the step's shuffle files go as soon as it is written."""
    with shuffle_files_dropped(df.sparkSession):
        return materialize(df, name)


def _comparable(queue: DataFrame, rules: SimilarityRules) -> DataFrame:
    """Queued reviews long enough to compare."""
    return queue.filter(
        (F.col("text_length") >= rules.min_length) & F.col("review_lang").isNotNull()
    ).select(
        F.col("review_id").alias("id"),
        "work_refid",
        F.col("review_lang").alias("lang"),
        F.col("text_length").alias("len"),
        F.col("date_processed").isNull().alias("pending"),
    )


def _digests(reviews: DataFrame) -> DataFrame:
    return reviews.select("id", "site_id", F.sha2("review", 256).alias("text_key"))


def text_members(queue: DataFrame, reviews: DataFrame, rules: SimilarityRules) -> DataFrame:
    """Queued reviews long enough to compare, each with the key of its text.

    Only the digest of a text travels here, not the text.
    """
    rows = _comparable(queue, rules)
    # Works without a pending review need no sets: nothing of theirs is asked for.
    asked = rows.filter("pending").select("work_refid", "lang").distinct()
    rows = rows.join(asked, ["work_refid", "lang"], "left_semi")
    return rows.join(_digests(reviews), "id")


CLASS_KEY = ["work_refid", "lang", "len", "text_key"]


def text_classes(members: DataFrame) -> DataFrame:
    """One row per distinct text of a work and language, by its lowest review id."""
    return members.groupBy(*CLASS_KEY).agg(F.min("id").alias("cid"), F.max("pending").alias("pending"))


def _packed(rows: DataFrame) -> DataFrame:
    """Rows with the packed trigram set of their review, and its size, in its place."""
    spark = rows.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    rows = rows.withColumn("grams", F.sort_array(trigrams("review"))).withColumn("n", F.size("grams")).drop("review")
    layout = [StructField(f.name, BinaryType() if f.name == "grams" else f.dataType) for f in rows.schema.fields]
    return rows.mapInArrow(_pack_sets, StructType(layout))


def _with_sets(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Classes with the packed trigram set of the text (cid, review) of their review ``cid``, and its size."""
    # The trigram sets are the expensive part. After a shuffled join the rows are
    # partitioned by class already and no exchange is added; after a broadcast the texts
    # are spread over all cores.
    return _packed(spread(classes.join(texts, "cid"), "cid"))


def _built_where_read(classes: DataFrame, texts: DataFrame) -> bool:
    """Whether sets are built where the texts are read, so that texts do not move.

    That is so if at least half of the texts need one and the splits hold about equal
    parts; both are counts, for which no text is read.
    """
    split = texts.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("many"))
    total, most = split.agg(F.sum("many"), F.max("many")).first()
    cores = texts.sparkSession.sparkContext.defaultParallelism
    return total is not None and most * cores <= 2 * total <= 4 * classes.count()


def _pack_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted trigram sets as the differences of neighbours, compressed."""
    for batch in batches:
        sets = batch["grams"]
        values = sets.flatten().to_numpy()
        ends = np.cumsum(sets.value_lengths().fill_null(0).to_numpy())
        steps = np.diff(values, prepend=values[:0].dtype.type(0))
        firsts = np.concatenate([[0], ends[:-1]])
        firsts = firsts[firsts < len(values)]
        steps[firsts] = values[firsts]
        data, start, packed = memoryview(steps.tobytes()), 0, []
        for end, known in zip(ends.tolist(), sets.is_valid().to_pylist(), strict=True):
            packed.append(zlib.compress(data[8 * start:8 * end]) if known else None)
            start = end
        i = batch.schema.get_field_index("grams")
        yield batch.set_column(i, "grams", pa.array(packed, pa.binary()))


def _unpack_sets(packed: pa.ChunkedArray) -> pa.ListArray:
    sets = [np.cumsum(np.frombuffer(zlib.decompress(x), np.int64)) for x in packed.to_pylist()]
    offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(sets))


def _placed(classes: DataFrame, rules: SimilarityRules) -> DataFrame:
    """Classes with their block and the pairs of tiles it goes to, as far as they can meet a pending one.

    A block's place on the scale of lengths follows from how many classes each cell of
    lengths has: partners lie in the same cell or one beside it. Inside a cell, classes are dealt.
    """
    group = ["work_refid", "lang"]
    step = math.log(rules.reach)
    rows = classes.withColumn("cell", F.floor(F.log("len") / F.lit(step)).cast("int"))
    cells = rows.groupBy(*group, "cell").agg(F.count(F.lit(1)).alias("many"), F.max("pending").alias("asks"))
    cells = _step(
        cells.withColumn("before", F.sum("many").over(Window.partitionBy(*group).orderBy("cell")) - F.col("many")), "cells")
    size = BLOCK * BUNDLE
    tiles = cells.select(
        *group, "cell", "asks",
        F.explode(F.sequence(F.floor(F.col("before") / size), F.floor((F.col("before") + F.col("many") - 1) / size))).alias("tile"),
    ).groupBy(*group, F.col("tile").cast("int").alias("tile")).agg(
        F.min("cell").alias("low"), F.max("cell").alias("high"), F.max("asks").alias("asks"))
    a = tiles.select(*group, F.col("tile").alias("a"), "high", "asks")
    b = tiles.select(*group, F.col("tile").alias("b"), "low", F.col("asks").alias("b_asks"))
    meet = a.join(b, group).filter("a <= b and low <= high + 1 and (asks or b_asks)")
    goes = meet.select(*group, F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"), F.struct("a", "b").alias("meet"))
    goes = goes.groupBy(*group, "tile").agg(F.sort_array(F.collect_list("meet")).alias("goes"))
    place = F.col("before") + F.pmod(F.xxhash64("cid", "text_key"), F.col("many"))
    width = F.round(F.col("len") * rules.length_delta)
    return (
        rows.join(cells.drop("asks"), [*group, "cell"])
        .withColumn("part", F.floor(place / BLOCK).cast("int"))
        .withColumn("tile", F.floor(F.col("part") / BUNDLE).cast("int"))
        .join(goes, [*group, "tile"])
        .select(*CLASS_KEY, "tile", "part", "goes", "cid", "pending", (F.col("len") - width).alias("low"),
                (F.col("len") + width).alias("high"))
    )


BLOCK_KEY = ["work_refid", "lang", "tile", "part", "goes"]
_BLOCK_FACTS = (
    "cid array<bigint>, len array<double>, low array<double>, high array<double>, n array<double>, "
    "pending array<boolean>, grams binary, counts binary, places binary"
)


def _pack(key: tuple, rows: pa.Table) -> pa.Table:
    """The classes of a slice as one row, by class id: their facts, and per trigram the places of its classes."""
    rows = rows.sort_by("cid")
    sets = rows["grams"].combine_chunks()
    grams = sets.flatten().to_numpy()
    places = np.repeat(np.arange(len(rows), dtype=np.uint16), sets.value_lengths().to_numpy())
    order = np.argsort(grams, kind="stable")
    distinct, counts = np.unique(grams, return_counts=True)
    lists = np.diff(places[order], prepend=places[:0].dtype.type(0))  # wraps around where a list begins
    row = dict(zip(BLOCK_KEY, (k.as_py() for k in key), strict=True))
    row |= {c: rows[c].to_numpy() for c in ("cid", "len", "low", "high", "n", "pending")}
    row |= {"grams": zlib.compress(np.diff(distinct, prepend=0), 1), "counts": zlib.compress(counts.astype(np.uint16), 1),
            "places": zlib.compress(lists, 1)}
    return pa.Table.from_pylist([row], schema=pa.schema([
        *((c, key[i].type) for i, c in enumerate(BLOCK_KEY)), ("cid", pa.list_(pa.int64())),
        *((c, pa.list_(pa.float64())) for c in ("len", "low", "high", "n")), ("pending", pa.list_(pa.bool_())),
        *((c, pa.binary()) for c in ("grams", "counts", "places"))]))


def _pack_blocks(small: int, most: int, reach: float):
    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        """A block as slices of classes of like length: ``small`` or more, ``most`` at most."""
        rows = rows.sort_by([("len", "ascending"), ("cid", "ascending")])
        lengths, start, out = rows["len"].to_numpy(), 0, []
        while start < len(rows):
            end = min(start + most, max(start + small, int(np.searchsorted(lengths, lengths[start] * reach, "right"))))
            lot = rows.slice(start, end - start)
            sets = _unpack_sets(lot["grams"])
            out.append(_pack(key, lot.set_column(lot.schema.get_field_index("grams"), "grams", sets)))
            start = end
        return pa.concat_tables(out)

    return pack


class _Block:
    """A packed slice, its lists of places spelled out."""

    def __init__(self, rows: pa.Table, i: int):
        for c in ("cid", "len", "low", "high", "n", "pending"):
            setattr(self, c, rows[c][i].values.to_numpy(zero_copy_only=False))
        self.size = len(self.cid)
        self.grams, self.counts, self.places = (
            np.frombuffer(zlib.decompress(rows[c][i].as_py()), kind)
            for c, kind in (("grams", np.int64), ("counts", np.uint16), ("places", np.uint16)))
        self.grams, self.places = np.cumsum(self.grams), np.cumsum(self.places, dtype=np.uint16)
        self.starts = np.cumsum(self.counts, dtype=np.int64) - self.counts

    def matrix(self, grams: np.ndarray) -> np.ndarray:
        """One row per trigram (by its number), one column per class."""
        m = np.zeros((len(grams), self.size), np.float32)
        counts = self.counts[grams]
        m[np.repeat(np.arange(len(grams)), counts), self.places[_ranges(self.starts[grams], counts)]] = 1
        return m


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    counts = counts.astype(np.int64)
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _shared(a: _Block, b: _Block) -> np.ndarray:
    """How many trigrams each class of a shares with each of b.

    Products of matrices for the frequent trigrams, counted pairs for the rare ones.
    """
    _, i, j = np.intersect1d(a.grams, b.grams, assume_unique=True, return_indices=True)
    met = a.counts[i].astype(np.int64) * b.counts[j]
    rare = met * RARE < a.size * b.size
    out = np.zeros((a.size, b.size), np.float32)
    often = np.flatnonzero(~rare)
    for k in range(0, len(often), SLICE):
        some = often[k:k + SLICE]
        out += a.matrix(i[some]).T @ b.matrix(j[some])
    i, j, met = i[rare], j[rare], np.cumsum(met[rare])
    for some in np.split(np.arange(len(i)), np.flatnonzero(np.diff(met // PAIRS)) + 1):
        mine, theirs = a.counts[i[some]], b.counts[j[some]]
        left = a.places[_ranges(a.starts[i[some]], mine)].astype(np.int64)
        each = np.repeat(theirs, mine)
        right = b.places[_ranges(np.repeat(b.starts[j[some]], mine), each)]
        out += np.bincount(np.repeat(left, each) * b.size + right, minlength=out.size).reshape(out.shape)
    return out


def _found(a: _Block, b: _Block, shared: np.ndarray, t: float) -> list[tuple]:
    """For the pending classes of a the first class of b each is similar to."""
    asks = np.flatnonzero(a.pending)
    if not len(asks):
        return []
    shared = shared[asks].astype(np.float64)
    similarity = shared / (a.n[asks, None] + b.n - shared)
    length = a.len[asks, None]
    hit = (b.cid < a.cid[asks, None]) & (similarity >= t) & (length >= b.low) & (length <= b.high)
    rows = np.flatnonzero(hit.any(axis=1))
    first = b.cid[hit[rows].argmax(axis=1)]
    # Rows of one id may differ in text: the least similarity counts.
    least = np.where(hit[rows] & (b.cid == first[:, None]), similarity[rows], 2).min(axis=1)
    return [(a.cid[asks[rows]], first, least)]


def _compare_tiles(t: float, reach: float):
    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        """Slices of one tile against those of the other, or among themselves, where lengths are within reach."""
        first = rows["tile"].to_numpy() == key[2].as_py()
        slices = [_Block(rows, i) for i in range(len(rows))]
        spans = [(x.len.min(), x.len.max()) for x in slices]
        own, found = key[2].as_py() == key[3].as_py(), []
        for i in np.flatnonzero(first):
            for j in range(i, len(slices)) if own else np.flatnonzero(~first):
                a, b = slices[i], slices[j]
                apart = spans[i][0] > spans[j][1] * reach or spans[j][0] > spans[i][1] * reach
                if apart or not (a.pending.any() or b.pending.any()):
                    continue
                shared = _shared(a, b)
                found += _found(a, b, shared, t)
                if i != j:
                    found += _found(b, a, shared.T, t)
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.zeros(0, k) for k in ("i8", "i8", "f8")]
        return pa.table(dict(zip(("cid", "other", "similarity"), columns, strict=True)))

    return compare


def _matches(classes: DataFrame, with_sets: Callable[[DataFrame], DataFrame], rules: SimilarityRules) -> DataFrame:
    """cid, other and similarity: earlier classes that pending ones are similar to, with the first one among them.

    ``with_sets`` gives placed classes their packed set and its size. What moves after that
    is slices, each with the tile it lies in, never sets by pairs.
    """
    ship_package(classes.sparkSession)
    # A set without trigrams is similar to nothing.
    sets = with_sets(_placed(classes, rules)).filter("n > 0").drop("text_key")
    sets = sets.withColumns({c: F.col(c).cast("double") for c in ("len", "n")})
    layout = StructType([StructField(c, sets.schema[c].dataType) for c in BLOCK_KEY] + StructType.fromDDL(_BLOCK_FACTS).fields)
    here = BLOCK_KEY[:-1]
    blocks = _step(
        spread(sets, *here).groupBy(*BLOCK_KEY).applyInArrow(
            _pack_blocks(SMALL_GROUP, BLOCK, rules.reach), layout),
        "blocks")
    sent = blocks.withColumn("meet", F.explode("goes")).drop("goes", "part").withColumns(
        {c: F.col(f"meet.{c}") for c in ("a", "b")}).drop("meet")
    both = ["work_refid", "lang", "a", "b"]
    return _step(
        spread(sent, *both).groupBy(*both).applyInArrow(
            _compare_tiles(rules.min_similarity, rules.reach), "cid bigint, other bigint, similarity double"),
        "met")


def similarity_groups(pairs: DataFrame) -> DataFrame:
    """review_id and group_id of every review in a similar pair.

    A group is what pairs (review_id, other_review_id) connect, named by its lowest id.
    """
    edges = pairs.select(F.col("review_id").alias("a"), F.col("other_review_id").alias("b"))
    return connected_components(edges, "similarity-groups").select(
        F.col("node").alias("review_id"), F.col("root").alias("group_id"))


def pick_similar(
    queue: DataFrame, reviews: DataFrame, rules: SimilarityRules = SimilarityRules()
) -> DataFrame:
    """For every pending review the lowest-numbered earlier review it is similar to."""
    members = _step(text_members(queue, reviews, rules), "members")
    classes = _step(text_classes(members), "classes")
    texts = reviews.select(F.col("id").alias("cid"), "review")

    def with_sets(placed: DataFrame) -> DataFrame:
        placed = _step(placed, "placed")
        if _built_where_read(placed, texts):
            return placed.join(_packed(texts), "cid")
        return _with_sets(placed, texts)

    matches = _matches(classes, with_sets, rules)
    sites = reviews.select(F.col("id").alias("cid"), "site_id")
    return _answers(members, classes.join(sites, "cid"), matches)


def _answers(members: DataFrame, classes: DataFrame, matches: DataFrame) -> DataFrame:
    """The answer of every pending member, given all classes it could be similar to and the similar ones."""
    best = matches.groupBy("cid").agg(
        F.min(F.struct(F.col("other"), F.col("similarity"))).alias("best")
    )
    sites = classes.select(F.col("cid").alias("other_review_id"), F.col("site_id").alias("other_site_id"))
    answers = (
        members.filter("pending")
        .select("id", "site_id", *CLASS_KEY)
        .join(classes.select("cid", *CLASS_KEY), CLASS_KEY)
        .join(best, "cid", "left")
        .select(
            "site_id",
            F.col("id").alias("review_id"),
            F.coalesce(F.col("best.other"), F.when(F.col("cid") < F.col("id"), F.col("cid"))).alias(
                "other_review_id"
            ),
            F.coalesce(F.col("best.similarity"), F.lit(1.0)).alias("similarity"),
        )
        .filter(F.col("other_review_id").isNotNull())
    )
    return answers.join(sites, "other_review_id").select(
        "site_id", "review_id", "other_site_id", "other_review_id", "similarity"
    )


# -- kept index ------------------------------------------------------------------------------


def _within(index: DataFrame, works: DataFrame) -> DataFrame:
    """Index rows of the given (work, language) pairs.

    Lots are sorted by work, and works are queued in the order of their number, so the span
    of the works is a filter the scan can leave out row groups by.
    """
    return _span(index, works).join(works, ["work_refid", "lang"], "left_semi")


def _span(index: DataFrame, works: DataFrame) -> DataFrame:
    """Index rows between the least and the most of some works."""
    least, most = works.agg(F.min("work_refid"), F.max("work_refid")).first()
    if least is None:
        return index.limit(0)
    return index.filter(F.col("work_refid").between(least, most))


def index_members(queue: DataFrame, reviews: DataFrame, known: DataFrame, rules: SimilarityRules = SimilarityRules()) -> DataFrame:
    """Rows a batch adds to the index of reviews: the pending ones that are not in it.

    id, work_refid, lang, len, site_id and text_key; only texts of pending reviews are read.
    """
    pending = _comparable(queue, rules).filter("pending").drop("pending")
    works = pending.select("work_refid", "lang").distinct()
    new = pending.join(_within(known, works).select("id"), "id", "left_anti")
    return new.join(_digests(reviews), "id").select("id", "work_refid", "lang", "len", "site_id", "text_key")


def index_classes(added: DataFrame, reviews: DataFrame, known: DataFrame) -> DataFrame:
    """Rows a batch adds to the index of texts: those of ``added`` members that are not in it.

    The class key with the packed set, n and bucket. A text's set is built when it is first met.
    """
    classes = added.groupBy(*CLASS_KEY).agg(F.min("id").alias("cid"))
    works = added.select("work_refid", "lang").distinct()
    new = classes.join(_within(known, works).select(*CLASS_KEY), CLASS_KEY, "left_anti")
    texts = reviews.select(F.col("id").alias("cid"), "review")
    return _with_sets(new.withColumn("bucket", _bucket(F.col("len"))), texts).select(*CLASS_KEY, "grams", "n", "bucket")


def by_work(rows: DataFrame) -> DataFrame:
    """Rows laid out as an index lot: ranges of works, sorted."""
    return rows.repartitionByRange("work_refid", "text_key").sortWithinPartitions("work_refid")


def pick_indexed(
    queue: DataFrame, members: DataFrame, classes: DataFrame, rules: SimilarityRules = SimilarityRules()
) -> DataFrame:
    """``pick_similar`` out of the index alone, which holds the pending reviews already.

    Partners are the indexed reviews of works with a pending review. Their sets are read
    only where the length lies within reach of a pending review of the same language.
    """
    pending = queue.filter(F.col("date_processed").isNull()).select(F.col("review_id").alias("id")).distinct()
    asked = _comparable(queue, rules).filter("pending").select("work_refid", "lang").distinct()
    here = _step(
        _within(members, asked).join(pending.withColumn("pending", F.lit(True)), "id", "left").withColumn(
            "pending", F.coalesce("pending", F.lit(False))),
        "members")
    near = here.filter("pending").select(
        "work_refid", "lang", F.explode(_other_buckets(F.col("len"), F.col("len"), rules.margin)).alias("bucket")).distinct()
    first = F.min(F.struct("id", "site_id"))
    grouped = here.groupBy(*CLASS_KEY).agg(first.alias("first"), F.max("pending").alias("pending")).select(
        *CLASS_KEY, F.col("first.id").alias("cid"), F.col("first.site_id").alias("site_id"), "pending")
    known = _step(
        grouped.withColumn("bucket", _bucket(F.col("len"))).join(near, ["work_refid", "lang", "bucket"], "left_semi").drop("bucket"),
        "classes")
    # The few facts of a class decide what is read; the sets meet them once.
    sets = _span(classes, asked)
    matches = _matches(
        known.drop("site_id"), lambda placed: placed.join(sets.select(*CLASS_KEY, "grams", "n"), CLASS_KEY), rules)
    return _answers(here, known.join(sets.select(*CLASS_KEY), CLASS_KEY), matches)
