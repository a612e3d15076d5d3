"""Text quality by naive Bayes support vectors.

A text is a set of n-gram indicators of two views of its words: the words themselves
(1- and 2-grams) and their shapes (1- to 3-grams: case, kind, closing signs, and whether a
word repeats the one before). Indicators are hashed into ``BUCKETS`` buckets.

1. *Log-count ratios*: over all labelled training texts, in how many texts of each class
   does each bucket occur? Each task adds up its own table; the tables meet in one sum per
   bucket. The ratio of the smoothed shares, as a logarithm, scales the indicator.
2. *Hinge loss*: a linear model over the scaled indicators, each text at unit length, is
   fitted by dual coordinate descent on at most ``SAMPLE`` training texts, those of the
   smallest id hash. The weights are drawn towards their mean magnitude.
3. *Scores*: a logistic function of the margin.

What reaches the driver and the workers is the bucket table and the sample, both of a
fixed size whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from shelfmark.llm.common import SPACES, chunks, mixed, packed, prepared, split_words, with_fields

BUCKETS = 1 << 18
SAMPLE = 6000  # training texts the linear model is fitted on, at most
PENALTY = 1.0  # C of the hinge loss
DRAWN = 0.25  # share of the fitted weights; the rest is their mean magnitude
EPOCHS = 30
STEEPNESS = 16.0
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def _shape(word: bytes) -> bytes:
    """Case and kind of a word and the signs that close it."""
    core = word.rstrip(_SIGNS)
    signs = word[len(core):]
    core = core.lstrip(_SIGNS).decode()
    if not core:
        kind = b"-"
    elif core.isdigit():
        kind = b"9"
    elif not core.isalpha():
        kind = b"x"
    elif core.islower():
        kind = b"a"
    elif core.isupper():
        kind = b"A" if len(core) > 1 else b"I"
    else:
        kind = b"Aa" if core[0].isupper() and core[1:].islower() else b"aA"
    return kind + signs[:1] + (b"+" if len(signs) > 1 else b"")


def _grams(codes: np.ndarray, starts: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that do not run over a text's start, and the place of each."""
    if len(codes) < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    gram = np.full(len(codes) - n + 1, salt, dtype=np.uint64)
    for i in range(n):
        gram = mixed(gram ^ codes[i:len(codes) - n + 1 + i]) + np.uint64(i + 1)
    crosses = np.zeros(len(codes) + 1, dtype=np.int64)
    inner = starts[(starts > 0) & (starts < len(codes))]
    crosses[inner] = 1
    seen = np.cumsum(crosses)
    places = np.flatnonzero(seen[n - 1:len(codes)] == seen[:len(codes) - n + 1])
    return gram[places], places


def features(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs of a chunk, in order."""
    words = split_words(column, SPACES)
    if not len(words):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words.values), dtype=np.uint64, count=len(words.values))
    shapes = np.fromiter((xxhash.xxh64_intdigest(_shape(v)) for v in words.values), dtype=np.uint64, count=len(hashes))
    word, shape = hashes[words.codes], shapes[words.codes]
    repeat = np.zeros(len(word), dtype=bool)
    repeat[1:] = words.codes[1:] == words.codes[:-1]
    starts = words.bounds[:-1]
    repeat[starts[starts < len(word)]] = False
    shape = shape ^ np.where(repeat, np.uint64(0x9E3779B97F4A7C15), np.uint64(0))
    row = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    keys = []
    for codes, n, salt in ((word, 1, 1), (word, 2, 2), (shape, 1, 3), (shape, 2, 4), (shape, 3, 5)):
        gram, places = _grams(codes, words.bounds, n, salt)
        keys.append(row[places] * buckets + (gram % np.uint64(buckets)).astype(np.int64))
    pairs = np.unique(np.concatenate(keys))
    return pairs // buckets, pairs % buckets


def _count(buckets: int):
    """Texts of each class a bucket occurs in, one table per task."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, buckets), dtype=np.int64)
        texts = np.zeros(2, dtype=np.int64)
        for part in chunks(batches):
            label = part.column("label").to_numpy()
            row, bucket = features(part.column("text"), buckets)
            for c in (0, 1):
                tables[c] += np.bincount(bucket[label[row] == c], minlength=buckets)
                texts[c] += int((label == c).sum())
        used = np.flatnonzero(tables.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(tables[0, used], texts[0])),
             pa.array(np.append(tables[1, used], texts[1]))], ["bucket", "zeros", "ones"])

    return count


def _listed(buckets: int):
    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            row, bucket = features(part.column("text"), buckets)
            offsets = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(bucket.astype(np.int32)))],
                ["label", "buckets"])

    return listed


@dataclass
class Model:
    """Per bucket the weight of its indicator and its squared scale."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    steepness: float = STEEPNESS

    def scores(self, column: pa.Array) -> np.ndarray:
        row, bucket = features(column, len(self.weights))
        total = np.bincount(row, self.weights[bucket], minlength=len(column))
        length = np.sqrt(np.bincount(row, self.squares[bucket], minlength=len(column)))
        margin = total / np.maximum(length, 1e-12) + self.bias
        return 1.0 / (1.0 + np.exp(-self.steepness * margin))


def descend(
    rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray,
    penalty: float = PENALTY, epochs: int = EPOCHS,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, by coordinate descent on its dual.

    Row i has the values ``scale[rows[i]]``, brought to unit length, and a constant 1 for
    the bias. One dual variable per row, kept between 0 and the penalty; classes count
    alike, so the rarer one has the larger penalty. Ends when no step moves by more than
    a thousandth.
    """
    weights, bias = np.zeros(len(scale)), 0.0
    values = []
    for row in rows:
        v = scale[row]
        values.append(v / max(float(np.sqrt(v @ v)), 1e-12))
    curvature = np.array([1.0 + float(v @ v) for v in values])
    share = np.array([(signs < 0).sum(), (signs > 0).sum()], dtype=float)
    top = penalty * len(signs) / (2 * np.maximum(share, 1))
    dual = np.zeros(len(rows))
    shuffled = np.random.default_rng(7)
    for _ in range(epochs):
        largest = 0.0
        for i in shuffled.permutation(len(rows)):
            row, v, sign = rows[i], values[i], signs[i]
            gradient = sign * (float(weights[row] @ v) + bias) - 1.0
            before = dual[i]
            dual[i] = min(max(before - gradient / curvature[i], 0.0), top[int(sign > 0)])
            step = (dual[i] - before) * sign
            if step:
                weights[row] += step * v
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return weights, bias


def _training(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """Training ids with one label each: labels 0 and 1 only, ids marked both ways left out."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter(
        "label = other").select("doc_id", "label")


def fit(docs: DataFrame, labels: DataFrame, held_out, buckets: int = BUCKETS, sample: int = SAMPLE) -> Model:
    """Fit on the labelled rows of ``docs`` that ``held_out(doc_id)`` does not hold back.

    Without training rows of both classes the model is indifferent: every score is 0.5.
    """
    prepared(docs.sparkSession)
    training = _training(docs, labels, held_out)
    texts = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
    counts = (
        # A merge join at every size: labels grow with the texts, so they are never broadcast.
        texts.join(training.hint("merge"), "doc_id").select("label", "text")
        .mapInArrow(_count(buckets), "bucket long, zeros long, ones long")
        .groupBy("bucket").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toArrow()
    )  # at most one row per bucket, and the numbers of texts as bucket -1
    bucket, zeros, ones = (counts.column(c).to_numpy() for c in ("bucket", "zeros", "ones"))
    indifferent = Model(np.zeros(buckets), np.zeros(buckets), 0.0)
    if not zeros[bucket < 0].sum() or not ones[bucket < 0].sum():
        return indifferent
    table = np.zeros((2, buckets))
    table[0, bucket[bucket >= 0]], table[1, bucket[bucket >= 0]] = zeros[bucket >= 0], ones[bucket >= 0]
    share = (table + 1.0) / (table + 1.0).sum(axis=1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    ratio[table.sum(axis=0) < 2] = 0.0
    chosen = F.broadcast(training.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = texts.join(chosen, "doc_id").select("label", "text").mapInArrow(
        _listed(buckets), "label int, buckets array<int>").orderBy(F.xxhash64("buckets")).limit(2 * sample).toArrow()
    signs = np.where(rows.column("label").to_numpy() > 0, 1.0, -1.0)
    if not (signs > 0).any() or not (signs < 0).any():
        return indifferent
    lists = rows.column("buckets").combine_chunks()
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    listed = [flat[x:y] for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
    weights, bias = descend(listed, signs, ratio)
    weights = (1 - DRAWN) * float(np.abs(weights).mean()) + DRAWN * weights
    return Model((weights * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), DRAWN * bias)


def _score(model, columns: list[str]):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(model.value.scores(part.column("text")))],
                [*columns, "score"])

    return score


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts get the score of no indicator."""
    prepared(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _score(docs.sparkSession.sparkContext.broadcast(model), ["doc_id"]), f"doc_id {id_type}, score double")


def of_quality(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (same columns) whose text scores at least ``least``."""
    prepared(docs.sparkSession)
    rows = packed(docs, "text")
    out = rows.mapInArrow(
        _score(docs.sparkSession.sparkContext.broadcast(model), ["row"]), with_fields(rows, ["row"], ("score", DoubleType())))
    return out.filter(F.col("score") >= least).select("row.*")


def held_back(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 1 modulo 3 are never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
