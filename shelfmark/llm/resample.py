"""Importance resampling towards a target: draw the documents most like a given collection.

Runs of words are hashed into buckets. A bucket's gain is the log ratio of its share in the
target to its share in the corpus, kept in one array; a document's weight is the mean of
its features' gains. A Gumbel term drawn from the id is added, so that the highest scores
are a sample without replacement by weight.

The k highest are found by a distributed quickselect. Random pivot keys are drawn from the
keys still in question, each pivot's three-way counts (less, equal, greater) are taken over
them, and the interval that holds the k-th key is what remains; a few passes over a narrow
table end at the key itself. Only the rows up to that key are sorted and ranked, each range
partition on its own with the number of rows before it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, LongType

from shelfmark.llm.common import NON_ALNUM, Words, chunks, packed, prepared, saved, split_words, text_key, with_fields

BUCKETS = 10_000
LONGEST = 2  # words in the longest run
LEAST_WORDS = 20  # shorter documents are never drawn
PERCENT = 25
SEED = 7
PIVOTS = 15

# The order of rows: highest score first, ties to the smaller id, rows without an id after
# the others, then by text hash. Rows equal in all four are equal for the draw.
KEY = ["below", "nameless", "doc_id", "text_hash"]


# Features --------------------------------------------------------------------------------


def _runs(words: Words, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """crc32 of the runs of 1, 2, … words that start at each place, and whether the run ends in its text.

    A run's checksum goes on from that of the run one word shorter.
    """
    n = len(words)
    stops = np.repeat(words.bounds[1:], np.diff(words.bounds))
    first = np.fromiter(map(zlib.crc32, words.values), dtype=np.int64, count=len(words.values))
    sums = first[words.codes] if n else np.zeros(0, dtype=np.int64)
    yield sums, np.ones(n, dtype=bool)
    spaced = [b" " + v for v in words.values]
    for size in range(2, longest + 1):
        last = words.codes[size - 1:].tolist() if n >= size else []
        longer = np.zeros(n, dtype=np.int64)
        longer[:len(last)] = np.fromiter(
            map(zlib.crc32, (spaced[c] for c in last), sums[:len(last)].tolist()), dtype=np.int64, count=len(last))
        sums = longer
        yield sums, np.arange(size, n + size) <= stops


def _count(buckets: int, longest: int):
    """Feature counts of a task's texts, one row per bucket that occurs."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for part in chunks(batches):
            for sums, whole in _runs(split_words(part.column("text"), NON_ALNUM, lower=True), longest):
                total += np.bincount(sums[whole] % buckets, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])

    return count


def feature_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts fall into each bucket; at most one row per bucket comes back."""
    prepared(texts.sparkSession)
    counts = texts.select("text").mapInArrow(_count(buckets, longest), "bucket int, n long")
    rows = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


@dataclass
class Gains:
    """Gain of each bucket, in thousandths."""

    values: np.ndarray
    longest: int


def fit(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> Gains:
    """Gains from all texts of ``docs`` and ``target`` (column text; null: no words).

    One is added to every count, so empty tables give finite gains.
    """
    own, other = (feature_counts(t, buckets, longest).tolist() for t in (docs, target))
    all_own, all_other = sum(own) + buckets, sum(other) + buckets
    return Gains(np.array(
        [math.floor(1000 * math.log((t + 1) * all_own / ((s + 1) * all_other))) for s, t in zip(own, other, strict=True)],
        dtype=np.int64), longest)


# Scores ----------------------------------------------------------------------------------


def _weigh(gains, columns: list[str]):
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Gains = gains.value
        for part in chunks(batches):
            words = split_words(part.column("text"), NON_ALNUM, lower=True)
            total, n = np.zeros(len(words) + 1, dtype=np.int64), np.zeros(part.num_rows, dtype=np.int64)
            n_words = np.diff(words.bounds)
            for size, (sums, whole) in enumerate(_runs(words, model.longest), start=1):
                total[1:] += np.where(whole, model.values[sums % len(model.values)], 0)
                n += np.maximum(n_words - size + 1, 0)
            before = np.cumsum(total)
            weight = np.floor_divide(before[words.bounds[1:]] - before[words.bounds[:-1]], np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(n_words.astype(np.int64)), pa.array(n), pa.array(weight)],
                [*columns, "n_words", "n_features", "weight"])

    return weigh


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _scored(rows: DataFrame, gains: Gains, seed: int, *carried: str) -> DataFrame:
    """The carried columns, n_words, n_features, weight, score and KEY of rows of doc_id and text."""
    prepared(rows.sparkSession)
    columns = list(dict.fromkeys(["doc_id", "text_hash", *carried]))
    keyed = rows.withColumn("text_hash", text_key())
    numbers: list[tuple[str, DataType]] = [(c, LongType()) for c in ("n_words", "n_features", "weight")]
    weighed = keyed.select(*columns, "text").mapInArrow(
        _weigh(rows.sparkSession.sparkContext.broadcast(gains), columns), with_fields(keyed, columns, *numbers))
    score = (F.col("weight") + _noise(F.col("doc_id"), seed)).cast("long")
    return weighed.withColumn("score", score).withColumn("below", -score).withColumn("nameless", F.col("doc_id").isNull())


# Selection -------------------------------------------------------------------------------


def _as_key(columns: list[str], values, layout) -> Column:
    return F.struct(*(F.lit(v).cast(layout[c].dataType).alias(c) for c, v in zip(columns, values, strict=True)))


def kth_key(rows: DataFrame, columns: list[str], k: int, pivots: int = PIVOTS) -> tuple | None:
    """The k-th smallest composite key of ``rows`` (k from 1); None if there are fewer rows.

    Each pass draws at most ``pivots`` random keys from the rows between the two bounds and
    counts the rows less than and equal to each. A pass removes at least one key, on average
    all but one in ``pivots`` rows; whichever keys are drawn, the counts are exact and so is
    the result.
    """
    key = F.struct(*columns)
    layout = rows.select(*columns).schema
    inside, left = rows.select(*columns), k
    low = high = None
    while left > 0:
        between = inside
        if low is not None:
            between = between.filter(key > _as_key(columns, low, layout))
        if high is not None:
            between = between.filter(key < _as_key(columns, high, layout))
        drawn = {tuple(r) for r in between.withColumn("draw", F.rand()).orderBy("draw").limit(pivots).drop("draw").collect()}
        if not drawn:
            return None
        ordered = sorted(drawn)
        marks = [_as_key(columns, p, layout) for p in ordered]
        counts = between.agg(
            *(F.count_if(key < m).alias(f"less{i}") for i, m in enumerate(marks)),
            *(F.count_if(key == m).alias(f"equal{i}") for i, m in enumerate(marks))).first()
        passed = 0
        for i, pivot in enumerate(ordered):
            less, equal = counts[f"less{i}"], counts[f"equal{i}"]
            if left <= less:
                high = pivot
                break
            if left <= less + equal:
                return pivot
            low, passed = pivot, less + equal
        left -= passed
    return None


def _chosen(rows: DataFrame, least_words: int, percent: int, pivots: int) -> tuple[DataFrame, int, tuple | None]:
    """``rows`` with could (long enough to be drawn), how many are drawn, and the last drawn key."""
    rows = rows.withColumn("could", F.col("n_words") >= least_words)
    k = rows.filter("could").count() * percent // 100
    return rows, k, kth_key(rows.filter("could"), KEY, k, pivots) if k else None


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with rank from 1 in the order of KEY.

    Ranges are sorted and written once with each row's place in its range; a range's first
    rank is the number of rows in the ranges before it (one number per range).
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    placed = saved(rows.repartitionByRange(n, *KEY).sortWithinPartitions(*KEY).withColumn("at", place), "ranked-rows")
    part, at = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = {r["part"]: r["count"] for r in placed.groupBy(part.alias("part")).count().collect()}
    before, starts = 0, []
    for p in sorted(sizes):
        starts.append((p, before))
        before += sizes[p]
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "part long, before long"))
    return placed.withColumn("part", part).join(starts, "part").withColumn(
        "rank", F.col("before") + at + 1).drop("part", "at", "before")


def importance_ranks(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
    buckets: int = BUCKETS, longest: int = LONGEST, pivots: int = PIVOTS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``.

    Of the rows with at least ``least_words`` words the ``percent`` in a hundred (rounded
    down) of the highest score are drawn and ranked from 1, ties to the smaller id, then to
    rows without an id, then by text; of rows equal in id and text as many are drawn as
    there are ranks left. The others have no rank. A null text has no words; a null id
    takes the noise of an empty one. Rows are told apart only by place, so repeated rows
    stay. Other columns are ignored, and an empty table gives no rows.
    """
    rows = saved(_scored(docs.select("doc_id", "text"), fit(docs, target, buckets, longest), seed), "scores")
    rows, k, last = _chosen(rows, least_words, percent, pivots)
    out = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    unranked = rows.withColumn("rank", F.lit(None).cast("long"))
    if last is None:
        return unranked.select(*out)
    up_to = F.col("could") & (F.struct(*KEY) <= _as_key(KEY, last, rows.select(*KEY).schema))
    winners = _ranked(rows.filter(up_to)).withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return winners.select(*out).union(unranked.filter(~up_to).select(*out))


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
    buckets: int = BUCKETS, longest: int = LONGEST, pivots: int = PIVOTS,
) -> DataFrame:
    """The drawn rows of ``docs`` (same columns), by the rules of ``importance_ranks``.

    Of rows equal in id and text that share the last rank, whichever Spark takes first.
    """
    prepared(docs.sparkSession)
    whole = packed(docs, "doc_id", "text")
    rows = _scored(whole, fit(docs, target, buckets, longest), seed, "row")
    narrow = saved(rows.select(*KEY, "n_words"), "scores")
    narrow, k, last = _chosen(narrow, least_words, percent, pivots)
    if last is None:
        return docs.limit(0)
    key, mark = F.struct(*KEY), _as_key(KEY, last, narrow.select(*KEY).schema)
    sure = narrow.filter("could").filter(key < mark).count()
    could = rows.filter(F.col("n_words") >= least_words)
    return could.filter(key < mark).select("row.*").union(could.filter(key == mark).limit(k - sure).select("row.*"))


def resample_report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``."""
    return importance_ranks(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
