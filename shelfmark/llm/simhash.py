"""Near-duplicate groups by SimHash, with deletion-variant signatures as the index.

A text's fingerprint has a bit set where over half of its shingles' hashes have it. Two
texts are linked if their fingerprints differ in at most ``distance`` (3) bits.

*Index.* A fingerprint is cut into two halves of 32 bits. Three differing bits leave one
half with at most one, so linked fingerprints share a half up to one bit: each half is
indexed under 32 variants, each with one bit deleted, and variants are joined on equality.
Members of a bucket are verified by their bit distance.

*Large buckets.* A bucket of more than ``bucket`` fingerprints is not compared within: its
members are indexed again inside it by the other half, cut in two and with one bit deleted
the same way, and once more where that is still too large. After the third level all but
11 bits of a member are fixed, so no bucket can hold more than 2**11 of them. Every level
uses the same pigeonhole argument, so no link is lost and no group is ever large.

Equal fingerprints are one node from the start. Buckets return, for each member, a link to
the first member it is connected to, never all pairs. Components come from iterated
star steps over the links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import SPACES, Words, chunks, prepared, quoted, saved, signed, split_words, text_key
from shelfmark.operators.components import connected_components

SHINGLE = 3
DISTANCE = 3
BUCKET = 1 << 14  # fingerprints compared within one bucket, at most
SEED = 42
# Hashes whose bits are unpacked at a time.
_SLICE = 1 << 15


def _shingle_hashes(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a chunk and how many each text has.

    The words are laid out with one space between them, so a shingle is a slice.
    """
    counts = np.diff(words.bounds)
    lengths = words.ends - words.starts
    stops = np.cumsum(lengths + 1) - 1
    begins = stops - lengths
    laid = memoryview(b" ".join([words.data[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)]))
    per_text = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), per_text)
    first = np.arange(len(row)) - np.repeat(np.cumsum(per_text) - per_text, per_text) + words.bounds[row]
    last = np.minimum(first + shingle, words.bounds[row + 1]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(laid[a:b], SEED) for a, b in zip(begins[first].tolist(), stops[last].tolist(), strict=True)),
        dtype=np.uint64, count=len(first))
    return hashes, per_text


def _majority(hashes: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Fingerprint of each text: bits set in over half of its hashes; no hash gives 0."""
    out = np.zeros(len(per_text), dtype=np.uint64)
    have = np.flatnonzero(per_text)
    if not len(have):
        return out
    ends = np.cumsum(per_text[have])
    starts = ends - per_text[have]
    ones = np.zeros((len(have), 64), dtype=np.int64)
    for a in range(0, len(hashes), _SLICE):
        b = min(a + _SLICE, len(hashes))
        bits = np.unpackbits(hashes[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        lo, hi = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b, side="left")
        cuts = np.maximum(starts[lo:hi], a) - a
        ones[lo:hi] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    set_bits = ones * 2 > per_text[have][:, None]
    out[have] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _fingerprint(columns: list[str], shingle: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words = split_words(part.column("text"), SPACES, lower=True, coded=False)
            prints = _majority(*_shingle_hashes(words, shingle))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(signed(prints))], [*columns, "print"])

    return find


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and print (the 64-bit fingerprint as a signed long); no words: 0."""
    prepared(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprint(["doc_id"], shingle), f"doc_id {id_type}, print long")


def _variants(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of values of ``width`` bits under each deletion: (half, bit) numbers and the rest."""
    half = width // 2
    pieces = [values & np.uint64((1 << half) - 1), values >> np.uint64(half)]
    numbers, masked = [], []
    for h, piece in enumerate(pieces):
        for bit in range(half):
            numbers.append(np.full(len(values), h * half + bit, dtype=np.uint64))
            masked.append(piece & ~np.uint64(1 << bit))
    return np.stack(numbers, axis=1), np.stack(masked, axis=1)


def _other_half(values: np.ndarray, width: int, number: np.ndarray) -> np.ndarray:
    """The half that a (half, bit) number did not fix."""
    half = width // 2
    return np.where(number < half, values >> np.uint64(half), values & np.uint64((1 << half) - 1))


def _keyed(level: int):
    """Rows (bucket, print) of a level; bucket is a list of the numbers fixed so far, packed."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(start, 1 << 14)
                prints = part.column("print").to_numpy().view(np.uint64)
                free, width = prints, 64
                earlier = [part.column(f"k{i}").to_numpy().view(np.uint64) for i in range(1, level)]
                for key in earlier:
                    free, width = _other_half(free, width, key >> np.uint64(32)), width // 2
                numbers, masked = _variants(free, width)
                key = (numbers << np.uint64(32)) | masked
                copies = key.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(signed(np.repeat(k, copies))) for k in earlier),
                     pa.array(signed(key.ravel())), pa.array(signed(np.repeat(prints, copies)))],
                    [*(f"k{i}" for i in range(1, level + 1)), "print"])

    return find


def _linked(prints: np.ndarray, distance: int) -> np.ndarray:
    """For each member of a bucket the first member of its component.

    Members are reached breadth first and leave the set looked at when they are reached, so
    a crowd of close fingerprints takes few rounds, and memory grows with the members only.
    """
    first = np.arange(len(prints))
    left = first
    while len(left):
        root, left = left[0], left[1:]
        reached = [root]
        while reached and len(left):
            near = np.bitwise_count(prints[left] ^ prints[reached.pop()]) <= distance
            if near.any():
                new = left[near]
                first[new] = root
                reached += new.tolist()
                left = left[~near]
    return prints[first]


def _links(distance: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prints")
            offsets = lists.offsets.to_numpy()
            values = lists.flatten().to_numpy()
            offsets = offsets - offsets[0]
            sizes = np.diff(offsets)
            pairs = offsets[:-1][sizes == 2]
            x, y = values[pairs], values[pairs + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= distance
            a, b = [x[near]], [y[near]]
            for i in np.flatnonzero(sizes > 2).tolist():
                members = values[offsets[i]:offsets[i + 1]]
                least = _linked(members.view(np.uint64), distance).view(np.int64)
                moved = least != members
                a.append(members[moved])
                b.append(least[moved])
            a, b = np.concatenate(a), np.concatenate(b)
            once = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(once[:, 0])), pa.array(np.ascontiguousarray(once[:, 1]))], ["a", "b"])

    return find


def links(prints: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``distance`` (0 to 3) bits.

    ``prints`` has one row per distinct fingerprint.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two halves with one deleted bit reach distances up to 3")
    prepared(prints.sparkSession)
    found, rows = None, prints.select("print")
    for level in (1, 2, 3):
        keys = [f"k{i}" for i in range(1, level + 1)]
        indexed = rows.mapInArrow(_keyed(level), ", ".join(f"{k} long" for k in [*keys, "print"]))
        sizes = indexed.groupBy(*keys).agg(F.count("*").alias("members")).filter("members > 1")
        small = sizes if level == 3 else sizes.filter(F.col("members") <= bucket)
        groups = indexed.join(small.select(*keys), keys, "left_semi").groupBy(*keys).agg(
            F.collect_list("print").alias("prints"))
        here = saved(groups.select("prints").mapInArrow(_links(distance), "a long, b long").distinct(), f"links-{level}")
        found = here if found is None else found.union(here)
        if level < 3:
            large = sizes.filter(F.col("members") > bucket).select(*keys)
            rows = saved(indexed.join(large, keys, "left_semi"), f"large-{level}")
    return found.distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, bucket: int = BUCKET
) -> DataFrame:
    """doc_id, print and component_id (the smallest doc_id of the component) of every row.

    Texts without words, null texts among them, have the fingerprint 0 and are linked like
    any other. Rows that share an id or are equal are rows of their own; a component of
    null ids alone has a null component_id. Other columns are ignored.
    """
    prints = saved(fingerprints(docs, shingle), "prints")
    distinct = saved(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    rooted = _rooted(distinct, distance, bucket)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = saved(rooted.join(least, "root").select("print", "component_id"), "print-components")
    return prints.join(named, "print").select("doc_id", "print", "component_id")


def _rooted(distinct: DataFrame, distance: int, bucket: int) -> DataFrame:
    """``distinct`` (one row per print) with the root of each print's component."""
    roots = connected_components(links(distinct, distance, bucket), "near-duplicates")
    return distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        *(distinct[c] for c in distinct.columns), F.coalesce("root", "print").alias("root"))


def without_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, bucket: int = BUCKET
) -> DataFrame:
    """``docs`` with one row of each component: the row of the smallest doc_id.

    Rows are told apart by id and text, so an id that is repeated with texts of several
    components counts in each of them. Of several rows of a component with its smallest id
    the one with the smallest text hash stays, and one of rows equal in both. No component
    is named by a null id: of a component's rows without an id one stays as well.
    """
    prepared(docs.sparkSession)
    id_type, text = docs.schema["doc_id"].dataType.simpleString(), F.coalesce("text", F.lit(""))
    # Together 128 bits of the text; the second one tells ids of one text apart.
    key = [text_key().alias("text_hash"), F.xxhash64(F.lit(1), F.col("doc_id").isNull(), "doc_id", text).alias("row_hash")]
    names = ["doc_id", "text_hash", "row_hash"]
    prints = docs.select("doc_id", *key, "text").mapInArrow(
        _fingerprint(names, shingle), f"doc_id {id_type}, text_hash long, row_hash long, print long")
    first, nameless = F.struct(*names), F.col("doc_id").isNull()
    distinct = saved(prints.groupBy("print").agg(
        F.min(F.when(~nameless, first)).alias("named"), F.min(F.when(nameless, first)).alias("nameless")), "distinct-prints")
    firsts = _rooted(distinct, distance, bucket).groupBy("root").agg(
        F.min("named").alias("named"), F.min("nameless").alias("nameless"))
    kept = firsts.select(F.explode(F.array("named", "nameless")).alias("first")).filter("first is not null").select(
        "first.text_hash", "first.row_hash")
    matched = docs.select(*key, F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row")).join(
        kept, ["text_hash", "row_hash"], "left_semi")
    return matched.groupBy("text_hash", "row_hash").agg(F.first("row").alias("row")).select("row.*")
