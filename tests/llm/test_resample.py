import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from shelfmark.llm import resample

VOCABULARY = ["the", "Ñame", "été", "a", "of", "x9", "日本", "don", "THE", "long" * 30]


def features(text, longest):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(pairs, target, percent, least, buckets, longest):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in pairs for f in features(t, longest)[1])
    t = Counter(bucket(f) for _, x in target for f in features(x, longest)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    scored = []
    for i, text in pairs:
        words, found = features(text, longest)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, len(words), len(found), weight, score, text))
    could = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    return scored, could[:len(could) * percent // 100]


def text(rnd, n):
    return "".join(rnd.choice(VOCABULARY) + rnd.choice([" ", ", ", "\n", "-", "'"]) for _ in range(n))


def made(seed):
    rnd = random.Random(seed)
    pairs = [(i, text(rnd, rnd.randrange(0, 60))) for i in range(300)]
    pairs += [(1000 + i, "the of a " * 10) for i in range(100)] + [(None, text(rnd, 30)), (400, None), (401, ""), (402, "...")]
    return pairs, [(i, text(rnd, rnd.randrange(0, 20)) + "of x9 of x9 ") for i in range(30)] + [(99, None)]


@pytest.mark.parametrize("percent, least, buckets, longest, pivots", [
    (25, 20, 10_000, 2, 15), (100, 0, 50, 1, 1), (7, 5, 300, 4, 40), (0, 20, 10, 2, 3), (25, 10**6, 10, 2, 3)])
def test_equals_brute_force(docs, clashing, percent, least, buckets, longest, pivots):
    pairs, target = made(percent)
    extra = {**clashing, **dict.fromkeys(("below", "nameless", "could", "rank", "weight", "draw"), "x")}
    args = (percent, least, 7, buckets, longest, pivots)
    found = resample.importance_ranks(docs(pairs, **extra), docs(target), *args).collect()
    scored, drawn = brute(pairs, target, percent, least, buckets, longest)
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted((r[:5] for r in scored), key=str)
    ranks = sorted((r["rank"], r.doc_id) for r in found if r["rank"] is not None)
    assert ranks == [(n + 1, r[0]) for n, r in enumerate(drawn)]
    frame = docs(pairs, **extra)
    rows = resample.resampled(frame, docs(target), *args)
    assert rows.columns == frame.columns and rows.dtypes == frame.dtypes
    assert sorted(((r.doc_id, r.text) for r in rows.collect()), key=str) == sorted(((r[0], r[5]) for r in drawn), key=str)


def test_equal_rows_share_the_last_rank(docs):
    copies = [(5, "one two three " * 10)] * 40
    found = resample.importance_ranks(docs(copies), docs([(1, "one two")])).collect()
    assert sorted(r["rank"] for r in found if r["rank"] is not None) == list(range(1, 11)) and len(found) == 40
    assert resample.resampled(docs(copies), docs([(1, "one two")])).count() == 10


@pytest.mark.parametrize("pivots", [1, 4, 64])
def test_kth_key(spark, pivots):
    rnd = random.Random(pivots)
    values = [(rnd.randrange(8), rnd.choice([None, 1, 2]), f"é{rnd.randrange(3)}") for _ in range(200)]
    rows = spark.createDataFrame([(a, b is None, b, c) for a, b, c in values], "a long, n boolean, b int, c string")
    ordered = sorted(((a, b is None, b, c) for a, b, c in values), key=lambda r: (r[0], r[1], r[2] or 0, r[3]))
    for k in (1, 2, 57, 199, 200):
        assert resample.kth_key(rows, ["a", "n", "b", "c"], k, pivots) == ordered[k - 1]
    assert resample.kth_key(rows, ["a", "n", "b", "c"], 201, pivots) is None


def test_empty_tables(docs):
    assert resample.resample_report(docs([]), docs([(1, "a b")])).count() == 0
    assert resample.resampled(docs([]), docs([])).count() == 0
    pairs, _ = made(1)
    assert resample.resample_report(docs(pairs), docs([])).count() == len(pairs)
