import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels, quality.held_back)
    found = quality.scored(docs, model).filter(quality.held_back(F.col("doc_id"))).join(labels, "doc_id")
    rows = found.select("quality", "score").collect()
    assert len(rows) > 50
    right = [(r.score >= 0.5) == bool(r.quality) for r in rows]
    assert np.mean(right) > 0.95
    assert all(0.0 <= r.score <= 1.0 for r in rows)


def test_held_out_labels_teach_nothing(spark, docs):
    texts = docs([(i, f"text number {i}") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    one = quality.fit(texts, labels, quality.held_back)
    turned = labels.withColumn("quality", F.when(quality.held_back(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    two = quality.fit(texts, turned, quality.held_back)
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_odd_rows(spark, docs, clashing):
    pairs = [(1, "good text here."), (2, "BAD!! BAD!!"), (3, None), (4, ""), (None, "good text"), (1, "good text again."),
             (5, "x" * 100_000), (6, "word " * 20_000)]
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 0), (3, None), (None, 1), (4, 7), (6, 1), (6, 0)], "doc_id bigint, quality int")
    frame = docs(pairs, **clashing)
    model = quality.fit(frame, labels, lambda c: F.lit(False))
    got = quality.scored(frame, model).collect()
    assert len(got) == len(pairs) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1
    kept = quality.of_quality(frame, model)
    assert kept.columns == frame.columns and kept.count() == sum(r.score >= 0.5 for r in got)


def test_no_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.fit(docs([(1, "a")]), labels, quality.held_back)
    assert [r.score for r in quality.scored(docs([(1, "a")]), model).collect()] == [0.5]
    assert quality.scored(docs([]), model).count() == 0


def test_indicators_are_distinct_and_do_not_cross_texts():
    row, bucket = quality.features(pa.array(["a b a b", "a", None, "b a"]))
    assert len(set(zip(row.tolist(), bucket.tolist(), strict=True))) == len(row)
    alone = quality.features(pa.array(["a b a b"]))[1].tolist()
    assert bucket[row == 0].tolist() == alone


def test_descent_separates_and_meets_the_optimum():
    rng = np.random.default_rng(4)
    rows, signs = [], []
    for i in range(60):
        signs.append(1.0 if i % 3 else -1.0)
        rows.append(np.unique(np.append(rng.integers(0, 50, 6), 50 if signs[-1] > 0 else 51)))
    signs = np.array(signs)
    scale = np.ones(52)
    weights, bias = quality.descend(rows, signs, scale, epochs=300)

    def loss(w, b):
        top = np.where(signs > 0, len(signs) / 2 / (signs > 0).sum(), len(signs) / 2 / (signs < 0).sum())
        margin = np.array([w[r].sum() / np.sqrt(len(r)) + b for r in rows]) * signs
        return 0.5 * (w @ w + b * b) + (top * np.maximum(0, 1 - margin)).sum()

    best = loss(weights, bias)
    for _ in range(200):
        assert loss(weights + rng.normal(0, 0.02, 52), bias + rng.normal(0, 0.02)) >= best - 1e-3


@pytest.mark.parametrize("word, shape", [(b"word", b"a"), (b"Word,", b"Aa,"), (b"WORD!!", b"A!+"), (b"12", b"9"), (b"|", b"-|"), ("É".encode(), b"I")])
def test_shapes(word, shape):
    assert quality._shape(word) == shape


# A plain version: indicators as tuples of strings, no hashing, the dual solved to the end.

SIGNS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())


def plain_shape(word):
    core = word.rstrip(SIGNS)
    signs, core = word[len(core):], core.lstrip(SIGNS)
    if not core:
        kind = "-"
    elif core.isdigit():
        kind = "9"
    elif not core.isalpha():
        kind = "x"
    elif core.islower():
        kind = "a"
    elif core.isupper():
        kind = "A" if len(core) > 1 else "I"
    else:
        kind = "Aa" if core[0].isupper() and core[1:].islower() else "aA"
    return kind + signs[:1] + ("+" if len(signs) > 1 else "")


def plain_indicators(text):
    words = (text or "").split()
    shapes = [(plain_shape(w), i > 0 and words[i - 1] == w) for i, w in enumerate(words)]
    return {(kind, n, *seq[i:i + n]) for kind, seq, sizes in (("word", words, (1, 2)), ("shape", shapes, (1, 2, 3)))
            for n in sizes for i in range(len(seq) - n + 1)}


def plain_margins(texts, labelled, buckets):
    """Margins of all texts under a model of the labelled ones."""
    sets = [plain_indicators(t) for t, _ in labelled]
    index = {f: k for k, f in enumerate(sorted({f for s in sets for f in s}, key=str))}
    table = np.zeros((2, len(index)))
    for s, (_, label) in zip(sets, labelled, strict=True):
        for f in s:
            table[label, index[f]] += 1
    totals = table.sum(axis=1) + buckets
    ratio = np.log((table[1] + 1) / totals[1]) - np.log((table[0] + 1) / totals[0])
    ratio[table.sum(axis=0) < 2] = 0.0

    def row(s):
        v = np.zeros(len(index))
        for f in s:
            if f in index:
                v[index[f]] = ratio[index[f]]
        return v / max(np.sqrt(v @ v), 1e-12)

    x, y = np.array([row(s) for s in sets]), np.array([1.0 if label else -1.0 for _, label in labelled])
    top = np.array([quality.PENALTY * len(y) / (2 * (y == s).sum()) for s in y])
    dual, weights, bias = np.zeros(len(y)), np.zeros(len(index)), 0.0
    for _ in range(3000):
        for i in range(len(y)):
            new = min(max(dual[i] - (y[i] * (weights @ x[i] + bias) - 1) / (1 + x[i] @ x[i]), 0.0), top[i])
            weights, bias, dual[i] = weights + (new - dual[i]) * y[i] * x[i], bias + (new - dual[i]) * y[i], new
    weights = (1 - quality.DRAWN) * np.abs(weights).sum() / buckets + quality.DRAWN * weights
    return np.array([weights @ row(plain_indicators(t)) + quality.DRAWN * bias for t in texts]), ratio


def test_equals_plain_version(spark, docs):
    rnd = np.random.default_rng(11)
    good = ["The", "river", "runs", "slowly,", "past", "old", "mills.", "Nobody", "came", "today."]
    bad = ["BUY", "now!!", "click", "click", "$$$", "FREE", "x9x", "now!!", "old", "river"]
    texts = [" ".join(rnd.choice(good if i % 2 else bad, rnd.integers(4, 15))) for i in range(80)]
    frame = docs(list(enumerate(texts)))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    held = lambda c: c % 5 == 4
    model = quality.fit(frame, labels, held)
    margins, ratio = plain_margins(texts, [(texts[i], i % 2) for i in range(60) if i % 5 != 4], quality.BUCKETS)
    # Indicators meet in no bucket here, so the scales are the plain ones.
    scales = np.sort(model.squares[model.squares > 0])
    assert np.allclose(scales, np.sort((ratio * ratio)[ratio != 0]), rtol=1e-4)
    scores = {r.doc_id: r.score for r in quality.scored(frame, model).collect()}
    found = np.log([scores[i] / (1 - scores[i]) for i in range(80)]) / quality.STEEPNESS
    assert np.abs(found - margins).max() < 0.02
    assert all((scores[i] >= 0.5) == (margins[i] >= 0) for i in range(80) if abs(margins[i]) > 0.02)
