import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import simhash
from shelfmark.operators.components import connected_components


def fingerprint(text, shingle=3):
    lower = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    if not lower:
        return 0
    parts = [b" ".join(lower[i:i + shingle]) for i in range(max(1, len(lower) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance):
    """Component number of each print, by comparing all pairs."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, p in enumerate(prints):
        for j in range(i):
            if bin(p ^ prints[j]).count("1") <= distance and root(i) != root(j):
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def test_equals_brute_force(docs, clashing):
    rnd = random.Random(2)
    base = [" ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(30)}" for _ in range(rnd.randrange(0, 120))) for _ in range(25)]
    texts = list(base)
    for t in base:
        words = t.split()
        for _ in range(rnd.randrange(0, 4)):
            if words:
                words[rnd.randrange(len(words))] = "changed"
                texts.append("  ".join(words).upper())
    pairs = list(enumerate(texts)) + [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "one two"), (7, "other text")]
    prints = [fingerprint(t) for _, t in pairs]
    label = groups(prints, 3)
    least = {}
    for (i, _), r in zip(pairs, label, strict=True):
        least[r] = min(i, least.get(r, i))
    want = sorted((i, p, least[r]) for (i, _), p, r in zip(pairs, prints, label, strict=True))
    got = sorted((r.doc_id, r.print % 2**64, r.component_id) for r in simhash.near_duplicates(docs(pairs, **clashing)).collect())
    assert got == want


@pytest.mark.parametrize("bucket, distance, crowds, size", [(1, 3, 3, 8), (4, 1, 3, 12), (16, 3, 4, 20), (1 << 14, 3, 8, 60), (1 << 14, 0, 2, 40)])
def test_links_of_crowded_fingerprints(spark, bucket, distance, crowds, size):
    """Chains and crowds of close fingerprints, through all three levels of the index."""
    rnd = random.Random(bucket + distance)
    prints = set()
    for _ in range(crowds):
        p = rnd.getrandbits(64)
        for _ in range(size):
            for _ in range(rnd.randrange(0, 5)):
                p ^= 1 << rnd.randrange(64)
            prints.add(p)
    prints |= {rnd.getrandbits(64) for _ in range(20)} | {0, 2**64 - 1, 1, 3, 7, 15}
    prints = sorted(prints)
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print long")
    roots = {r.node: r.root for r in connected_components(simhash.links(frame, distance, bucket)).collect()}
    got = {}
    for p in prints:
        s = int(np.uint64(p).view(np.int64))
        got.setdefault(roots.get(s, s), set()).add(p)
    want = {}
    for p, r in zip(prints, groups(prints, distance), strict=True):
        want.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_one_row_of_each_group_stays(docs, clashing):
    text = " ".join(f"w{i}" for i in range(200))
    pairs = [(3, text), (9, text), (9, text), (5, text.upper()), (4, "quite another text"), (None, text), (12, None), (11, "")]
    kept = simhash.without_near_duplicates(docs(pairs, **clashing))
    assert kept.columns == docs(pairs, **clashing).columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["11", "3", "4", "None"]
    repeated = docs([(1, "b b"), (1, "a a"), (1, "a a")])
    assert simhash.without_near_duplicates(repeated).count() == len({fingerprint(t) for t in ("a a", "b b")}) or \
        simhash.without_near_duplicates(repeated).count() == 1


def test_each_component_keeps_one_row_whatever_ids_repeat(docs, clashing):
    """Ids that name one component and occur in another; copies among rows without an id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    pairs = [(5, a), (9, a), (3, b), (5, b), (1, "b b"), (1, "a a"), (1, "a a"), (None, c), (None, c), (None, c.upper()), (None, c + " ")]
    assert len({fingerprint(t) for t in (a, b, c, "a a", "b b")}) == len(set(groups([fingerprint(t) for t in (a, b, c, "a a", "b b")], 3))) == 5
    frame = docs(pairs, **clashing)
    kept = simhash.without_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted((str(r.doc_id), r.text.lower().strip()) for r in kept.collect()) == sorted(
        [("5", a), ("3", b), ("1", "a a"), ("1", "b b"), ("None", c)])


def test_rows_kept_equal_brute_force(docs):
    rnd = random.Random(5)
    texts = ["", None, *(f"{x} {x}" for x in "abcdefgh"), *("  ".join(f"{x}{i}" for i in range(60)) for x in "pqrs")]
    pairs = [(rnd.randrange(6), t if t is None or rnd.random() < 0.5 else t.upper()) for t in texts for _ in range(4)]
    label = groups([fingerprint(t) for _, t in pairs], 3)
    want = {r: min(i for (i, _), x in zip(pairs, label, strict=True) if x == r) for r in set(label)}
    kept = simhash.without_near_duplicates(docs(pairs)).collect()
    found = {label[pairs.index((k.doc_id, k.text))]: k.doc_id for k in kept}
    assert found == want and len(kept) == len(want)


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.without_near_duplicates(docs([])).count() == 0


def test_distance_beyond_the_index(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "print long"), distance=4)


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    far = spark.createDataFrame([(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in connected_components(edges.union(far)).collect()}
    assert found == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
