import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import topk


def brute(rows, is_query, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(usable):
        if is_query(q):
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i)
                            for j, (i, w) in enumerate(usable) if j != at and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_rows, block", [(8192, 2048), (16, 2)])
@pytest.mark.parametrize("spread", [1.0, 0.01])
def test_equals_brute_force(spark, rows, slice_rows, block, spread):
    rnd = random.Random(3)
    made = [(i, [rnd.gauss(0, spread) for _ in range(6)]) for i in range(150)]
    made += [(200 + i, [0.0] * 6) for i in range(5)] + [(300 + i, made[0][1]) for i in range(8)]
    made += [(0, made[9][1]), (9, made[9][1]), (400, None), (401, [1.0, None] + [0.0] * 4), (402, [float("nan")] * 6),
             (403, [float("inf")] * 6), (None, made[1][1]), (410, [1.0, 2.0]), (420, []), (430, [2.0, 1.0]), (440, [])]
    frame = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in made], "vec_id bigint, embedding array<double>, rank string, score int")
    got = topk.top_scores(frame, F.col("vec_id") % 10 == 0, 5, block, slice_rows)
    assert rows(got) == brute(made, lambda i: i % 10 == 0, 5)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_scores(frame, F.col("vec_id") % 50 == 0).count() == 0


def test_repeated_ids(spark, rows):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert rows(topk.top_scores(frame, F.col("vec_id") == 0)) == [
        (0, 1, 1, 65536), (0, 1, 1, 65536), (0, 2, 0, 0), (0, 2, 0, 0)]


def test_reading_stops_when_outsiders_cannot_qualify():
    rng = np.random.default_rng(1)
    vectors = np.floor(rng.normal(0, 3, (4000, 8)))
    vectors[:5] = 200
    part = topk._Slice(np.arange(4000), np.arange(4000), vectors)
    queries = np.array([np.full(8, 100.0), np.full(8, 50.0)])
    found = list(part.best(queries, np.array([10**9, 2]), 5, np.full(2, -np.inf)))
    assert [f[0] for f in found] == [0, 1]
    assert found[0][1].tolist() == [0, 1, 2, 3, 4] and found[0][2].tolist() == [160000.0] * 5
    assert found[1][1].tolist()[:4] == [0, 1, 3, 4]
    only = list(part.best(queries[:1], np.array([10**9]), 5, np.full(1, -np.inf)))
    assert only[0][1].tolist() == [0, 1, 2, 3, 4] and part.depth == 500
