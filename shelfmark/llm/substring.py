"""Substring deduplication by seed and extend.

Words are maximal runs of bytes other than space, tab, LF, VT, FF and CR. A repeat is a
sequence of ``length`` words that starts at two or more places of the corpus.

1. *Seeds*: every text is winnowed. Among the word k-grams (k = ``seed_words``) of each
   window of ``length`` words the smallest hash is an anchor, so two equal windows have
   an equal anchor at the same place. Anchors are counted; those seen once cannot be part
   of a repeat.
2. *Surroundings*: a window that holds an anchor reaches ``length - k`` words to its left and
   right at most. Occurrences with equal surroundings that far match each other in full;
   they go on as one, so copies are never compared one by one.
3. *Extension*: the different surroundings of an anchor are a class. All of them are joined
   with one representative of the class and extended to the left and the right word by
   word; matches of ``length`` words or more count for both sides. A member may match
   another one further than the representative, but only one that leaves the representative
   at the same place with the same word: those go on as smaller classes with representatives
   of their own, until none is left. Pairs of a class are never listed, and nothing is lost.
4. *Maximal repeats*: what an occurrence matches holds its anchor, so the furthest reaches to
   either side bound it; overlapping matches are merged per text into maximal spans.

Counts combine before the shuffle. Every side joined to places or members is unique on its
key, so the rows of a hot anchor or class can be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.common import (
    SPACES, Words, chunks, free_name, mixed, prepared, ranges, saved, signed, split_words, text_bytes, text_key,
)

LENGTH = 35
SEED_WORDS = 18
OFTEN = 10_000  # surroundings with more than one in so many of all places are broadcast: fewer than so many rows
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so each has an inverse modulo 2**64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Rolling:
    """Hashes of any run of consecutive words of a chunk, from prefix sums."""

    def __init__(self, hashes: np.ndarray, base: int):
        self.prefix = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * _powers(base, len(hashes))[:-1], out=self.prefix[1:])
        self.back = _powers(pow(base, -1, 1 << 64), len(hashes))

    def of(self, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return mixed((self.prefix[starts + length] - self.prefix[starts]) * self.back[starts])


def _word_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    digests = b"".join(map(xxhash.xxh3_128_digest, words.values))
    both = np.frombuffer(digests, dtype=np.uint64).reshape(-1, 2)
    return both[words.codes, 0], both[words.codes, 1]


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over values[i:i + width] for every i that has so many."""
    out, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        out = pick(out[:len(out) - step], out[step:])
        reach += step
    return out


def _anchors(words: Words, seeds: np.ndarray, seed_words: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Valid window starts, the smallest seed hash of each, and which words are anchors.

    ``seeds[i]`` is the hash of the k-gram at word i. Of equal smallest hashes in a window
    all are anchors, which depends on the window's words alone.
    """
    n, width = len(words), length - seed_words + 1
    chosen = np.zeros(n, dtype=bool)
    counts = np.diff(words.bounds)
    starts = ranges(words.bounds[:-1], np.maximum(counts - length + 1, 0))
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64), chosen
    smallest = _sliding(seeds, width, np.minimum)
    least = np.zeros(n + width, dtype=np.uint64)  # 0 where no window starts
    least[starts + width - 1] = smallest[starts]
    # A k-gram is an anchor if some window that holds it has it as the smallest.
    largest = _sliding(least, width, np.maximum)[:n]
    chosen[:len(seeds)] = (largest[:len(seeds)] == seeds) & (seeds > 0)
    return starts, smallest[starts], chosen


def _seeds(words: Words, rolling: _Rolling, seed_words: int) -> np.ndarray:
    n = len(words) - seed_words + 1
    return rolling.of(np.arange(n), seed_words) | np.uint64(1) if n > 0 else np.zeros(0, dtype=np.uint64)


def _find_seeds(seed_words: int, length: int):
    """Hashes of a text's anchors."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words = split_words(part.column("text"), SPACES)
            seeds = _seeds(words, _Rolling(_word_hashes(words)[0], _BASES[0]), seed_words)
            _, _, chosen = _anchors(words, seeds, seed_words, length)
            yield pa.RecordBatch.from_arrays([pa.array(signed(seeds[np.flatnonzero(chosen)]))], ["seed"])

    return find


def _find_anchors(seed_words: int, length: int):
    """Anchors of a text with a hash of their surroundings and how far these reach."""
    reach = length - seed_words

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words = split_words(part.column("text"), SPACES)
            first, second = _word_hashes(words)
            seeds = _seeds(words, _Rolling(first, _BASES[0]), seed_words)
            _, _, chosen = _anchors(words, seeds, seed_words, length)
            at = np.flatnonzero(chosen)
            row = np.searchsorted(words.bounds, at, side="right") - 1
            start = np.maximum(at - reach, words.bounds[row])
            stop = np.minimum(at + length, words.bounds[row + 1])
            place = ((at - start) << 32 | (stop - at)).astype(np.uint64)
            around = mixed(_Rolling(second, _BASES[1]).of(start, stop - start) ^ mixed(place))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), part.column("text_hash").take(pa.array(row)),
                 pa.array(signed(seeds[at])), pa.array(signed(around)), pa.array((at - words.bounds[row]).astype(np.int32)),
                 pa.array((at - start).astype(np.int32)), pa.array((stop - at - seed_words).astype(np.int32))],
                ["doc_id", "text_hash", "seed", "around", "at", "before", "after"])

    return find


_MEMBER = "seed long, around long, class_1 long, class_2 long, low int, high int, left binary, right binary"


def _surroundings(seed_words: int, length: int):
    """Word hashes left and right of the wanted anchors, nearest first, 0 beyond the text.

    ``low`` to ``high`` is how many words may lie left of the anchor in a window of the text.
    """
    reach = length - seed_words

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words = split_words(part.column("text"), SPACES)
            wanted = part.column("wanted")
            row = np.repeat(np.arange(len(part)), np.diff(wanted.offsets.to_numpy()))
            seed, around, at = (wanted.flatten().field(k).to_numpy() for k in range(3))
            at = at + words.bounds[row]
            hashes = np.append(_word_hashes(words)[1] | np.uint64(1), np.uint64(0))
            steps = np.arange(reach)
            left, right = at[:, None] - 1 - steps, at[:, None] + seed_words + steps
            left = hashes[np.where(left >= words.bounds[row][:, None], left, -1)]
            right = hashes[np.where(right < words.bounds[row + 1][:, None], right, -1)]
            low = reach - (right > 0).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed), pa.array(around), pa.array(seed), pa.array(np.zeros(len(seed), dtype=np.int64)),
                 pa.array(low.astype(np.int32)), pa.array((left > 0).sum(axis=1).astype(np.int32)),
                 pa.array([w.tobytes() for w in left], pa.binary()), pa.array([w.tobytes() for w in right], pa.binary())],
                ["seed", "around", "class_1", "class_2", "low", "high", "left", "right"])

    return find


def _equal_words(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many words from the nearest on are equal, row by row."""
    differ = np.ones((len(one), one.shape[1] + 1), dtype=bool)
    differ[:, :-1] = (one != other) | (one == 0)
    return differ.argmax(axis=1)


def _extend(reach: int):
    """Members extended against their representative: matches, and members of smaller classes.

    A match has the words matched on both sides and no hashes. A member whose windows the
    representative does not settle goes on among those that leave it to the left at the same
    place with the same word, for windows that reach further left, and likewise to the right.
    """

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "left"):
            of = lambda name: part.column(name).to_numpy()
            words = lambda name: np.frombuffer(text_bytes(part.column(name))[0], dtype=np.uint64).reshape(-1, reach)
            left, right, low, high = words("left"), words("right"), of("low"), of("high")
            l, r = _equal_words(left, words("first_left")), _equal_words(right, words("first_right"))
            match = np.flatnonzero(l + r >= reach)
            none = np.zeros(len(match), dtype=np.int64)
            rows = [
                (of("seed")[match], of(name)[match], none, none, l[match], r[match], pa.nulls(len(match), pa.binary()),
                 pa.nulls(len(match), pa.binary()))
                for name in ("around", "first_around")
            ]
            one, two = of("class_1").astype(np.uint64), of("class_2").astype(np.uint64)
            further_left = (np.maximum(low, l + 1), high)
            further_right = (low, np.minimum(np.minimum(high, l), reach - r - 1))
            for side, matched, hashes, (least, most) in ((1, l, left, further_left), (2, r, right, further_right)):
                go = np.flatnonzero(least <= most)
                word = hashes[go, matched[go]]
                step = (matched[go] * 2 + side).astype(np.uint64)
                rows.append((
                    of("seed")[go], of("around")[go],
                    signed(mixed(one[go] * np.uint64(_BASES[0]) + mixed(word ^ mixed(step)))),
                    signed(mixed(two[go] * np.uint64(_BASES[1]) + mixed(mixed(word) + step))),
                    least[go], most[go], part.column("left").take(pa.array(go)), part.column("right").take(pa.array(go))))
            types = [pa.int64()] * 4 + [pa.int32()] * 2
            columns = [pa.array(np.concatenate(c).astype(t.to_pandas_dtype())) for c, t in zip(zip(*(x[:6] for x in rows)), types)]
            columns += [pa.concat_arrays([x[k] for x in rows]) for k in (6, 7)]
            yield pa.RecordBatch.from_arrays(
                columns, ["seed", "around", "class_1", "class_2", "low", "high", "left", "right"])

    return extend


def _matches(members: DataFrame, reach: int) -> DataFrame:
    """seed, around and the words matched to the left and right, from extensions in all classes."""
    found: list[DataFrame] = []
    first = F.min(F.struct((F.col("low") - F.col("high")).alias("short"), "around", "left", "right")).alias("first")
    while True:
        firsts = members.groupBy("class_1", "class_2").agg(first, F.count("*").alias("n")).filter("n > 1")
        met = members.join(firsts, ["class_1", "class_2"]).filter("around <> first.around").select(
            *members.columns, F.col("first.around").alias("first_around"),
            F.col("first.left").alias("first_left"), F.col("first.right").alias("first_right"))
        out = saved(met.mapInArrow(_extend(reach), _MEMBER), "extended")
        matched = out.filter("left IS NULL")
        found.append(matched.select("seed", "around", F.col("low").alias("to_left"), F.col("high").alias("to_right")))
        members = out.filter("left IS NOT NULL")
        if members.isEmpty():
            return reduce(DataFrame.unionAll, found)


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches of a text merged into maximal spans."""
    for part in batches:
        spans = []
        for found in part.column("found").to_pylist():
            merged: list[dict] = []
            for span in sorted(found, key=lambda s: s["first"]):
                if merged and span["first"] <= merged[-1]["stop"]:
                    merged[-1]["stop"] = max(merged[-1]["stop"], span["stop"])
                else:
                    merged.append(span)
            spans.append(merged)
        layout = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [part.column("span_id"), part.column("span_hash"), pa.array(spans, layout)], ["span_id", "span_hash", "spans"])


def repeated_texts(docs: DataFrame, seed_words: int = SEED_WORDS, length: int = LENGTH) -> DataFrame:
    """Texts that hold repeats: doc_id, text, text_hash, spans (first word, word after the last).

    ``docs`` has doc_id and text; other columns are ignored. A null text has no words. Rows
    may share an id or be equal: each row is an occurrence, so two equal rows of at least
    ``length`` words repeat each other, and a null id is an id like any other. One row per
    input row that holds a repeat.
    """
    if not 0 < seed_words <= length:
        raise ValueError("seed_words must be between 1 and length")
    prepared(docs.sparkSession)
    reach = length - seed_words
    keyed = docs.select("doc_id", "text", text_key().alias("text_hash"))
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    seeds = keyed.select("text").mapInArrow(_find_seeds(seed_words, length), "seed long")
    twice = saved(seeds.groupBy("seed").count().filter("count > 1").select("seed"), "repeated-seeds")
    places = keyed.mapInArrow(
        _find_anchors(seed_words, length),
        f"doc_id {id_type}, text_hash long, seed long, around long, at int, before int, after int")
    places = saved(places.join(twice, "seed", "left_semi"), "repeated-anchors")
    variants = saved(places.groupBy("seed", "around").agg(
        F.count("*").alias("n"), F.min("before").alias("before"), F.min("after").alias("after"),
        F.min(F.struct("doc_id", "text_hash", "at")).alias("place")), "anchor-surroundings")
    reaches = variants.filter("n > 1").select(
        "seed", "around", F.col("before").alias("to_left"), F.col("after").alias("to_right"))
    if reach:
        several = variants.groupBy("seed").count().filter("count > 1").select("seed")
        wanted = variants.join(several, "seed", "left_semi").groupBy(
            F.col("place.doc_id").alias("wanted_id"), F.col("place.text_hash").alias("wanted_hash")
        ).agg(F.collect_list(F.struct("seed", "around", "place.at")).alias("wanted"))
        texts = keyed.join(wanted, _same(keyed, wanted, "wanted")).select("text", "wanted")
        members = saved(texts.mapInArrow(_surroundings(seed_words, length), _MEMBER), "surroundings")
        reaches = reaches.unionAll(_matches(members, reach))
    reaches = saved(reaches.groupBy("seed", "around").agg(
        F.max("to_left").alias("to_left"), F.max("to_right").alias("to_right")), "reaches")
    total = variants.agg(F.sum("n")).first()[0] or 0
    often = F.broadcast(variants.filter(F.col("n") * OFTEN > total).select("seed", "around"))
    matched = places.join(F.broadcast(reaches.join(often, ["seed", "around"])), ["seed", "around"]).unionByName(
        places.join(often, ["seed", "around"], "left_anti").join(reaches, ["seed", "around"]))
    spans = saved(
        matched.select("doc_id", "text_hash", F.struct(
            (F.col("at") - F.col("to_left")).alias("first"),
            (F.col("at") + seed_words + F.col("to_right")).alias("stop")).alias("span"))
        .groupBy(F.col("doc_id").alias("span_id"), F.col("text_hash").alias("span_hash"))
        .agg(F.collect_set("span").alias("found"))
        .mapInArrow(_merged, f"span_id {id_type}, span_hash long, spans array<struct<first:int,stop:int>>"), "repeats")
    return keyed.join(spans, _same(keyed, spans, "span")).select("doc_id", "text", "text_hash", "spans")


def _same(keyed: DataFrame, other: DataFrame, prefix: str) -> Column:
    """The rows of a text: equal ids, null like any other, and equal hashes."""
    return keyed["doc_id"].eqNullSafe(other[f"{prefix}_id"]) & (keyed["text_hash"] == other[f"{prefix}_hash"])


def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their spans; kept words are joined by one space."""
    for part in chunks(batches):
        texts = part.column("text").to_pylist()
        spans = part.column("spans").to_pylist()
        total, removed, kept = [], [], []
        for text, gone in zip(texts, spans, strict=True):
            words = (text or "").encode().split()
            total.append(len(words))
            out, last = [], 0
            for span in gone or ():
                out += words[last:span["first"]]
                last = span["stop"]
            out += words[last:]
            removed.append(len(words) - len(out))
            kept.append(b" ".join(out))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_hash"), pa.array(total, pa.int64()),
             pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "text_hash", "n_words", "n_removed", "kept_text"])


def without_repeats(texts: DataFrame) -> DataFrame:
    """Rows of ``repeated_texts`` with doc_id, text_hash, n_words, n_removed, kept_text."""
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        _kept, f"doc_id {id_type}, text_hash long, n_words long, n_removed long, kept_text string")


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        split = [(text or "").encode().split() for text in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_hash"), pa.array([len(w) for w in split], pa.int64()),
             pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in split])],
            ["doc_id", "text_hash", "n_words", "whole_sha256"])


def removal_report(docs: DataFrame, seed_words: int = SEED_WORDS, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and the SHA-256 of the words that stay.

    Texts without a repeat are digested where they are read; only texts that hold one
    meet their spans.
    """
    prepared(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    cut = without_repeats(repeated_texts(docs, seed_words, length)).select(
        "doc_id", "text_hash", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
    cut = cut.groupBy("doc_id", "text_hash").agg(
        F.first("n_removed").alias("n_removed"), F.first("kept_sha256").alias("kept_sha256"))
    other = free_name(docs, "cut_id")
    cut = cut.withColumnsRenamed({"doc_id": other, "text_hash": "cut_hash"})
    every = docs.select("doc_id", "text", text_key().alias("text_hash")).mapInArrow(
        _counted, f"doc_id {id_type}, text_hash long, n_words long, whole_sha256 string")
    joined = every.join(
        cut, every["doc_id"].eqNullSafe(cut[other]) & (every["text_hash"] == cut["cut_hash"]), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))
