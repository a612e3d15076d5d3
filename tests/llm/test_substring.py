import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import substring


def brute(pairs, length):
    split = [(i, (t or "").encode().split()) for i, t in pairs]
    seen = Counter(tuple(w[s:s + length]) for _, w in split for s in range(len(w) - length + 1))
    out = []
    for i, w in split:
        gone = {p for s in range(len(w) - length + 1) if seen[tuple(w[s:s + length])] > 1 for p in range(s, s + length)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(rnd, n):
    words = [f"w{k}" for k in range(40)]
    passage = [rnd.choice(words) for _ in range(60)]
    texts = []
    for _ in range(n):
        t = [rnd.choice(words) for _ in range(rnd.randrange(0, 80))]
        if rnd.random() < 0.4:
            a = rnd.randrange(0, 50)
            t[rnd.randrange(len(t) + 1):0] = passage[a:a + rnd.randrange(5, 60)]
        if rnd.random() < 0.15:
            t += ["x"] * rnd.randrange(5, 60)
        texts.append(rnd.choice([" ", "\n", " \t "]).join(t))
    return texts


@pytest.mark.parametrize("seed_words, length", [(18, 35), (4, 9), (1, 1), (5, 5)])
def test_equals_brute_force(spark, docs, rows, clashing, seed_words, length):
    texts = made(random.Random(length), 40)
    pairs = list(enumerate(texts)) + [(1000, texts[0]), (1000, texts[0]), (1001, None), (None, texts[1]), (None, None),
                                      (1002, ""), (3, "one more text of the same id"), (1003, "  \n ")]
    got = substring.removal_report(docs(pairs, **clashing), seed_words, length)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute(pairs, length)


def test_empty_table(docs):
    assert substring.removal_report(docs([])).count() == 0


def test_one_word_repeated_very_often(spark, docs, rows):
    pairs = [(1, "go " * 30000), (2, "a b c"), (3, None)]
    assert rows(substring.removal_report(docs(pairs)), "doc_id", "n_removed") == [(1, 30000), (2, 0), (3, 0)]


def test_members_that_match_each_other_further_than_the_representative(spark, docs, rows):
    rnd = random.Random(7)
    passage = [f"p{k}" for k in range(30)]
    pairs = []
    for i in range(120):
        a, b = sorted(rnd.sample(range(31), 2))
        around = [f"r{rnd.randrange(3)}" for _ in range(8)]
        pairs.append((i, " ".join(around[:4] + passage[a:b] + around[4:])))
    got = substring.removal_report(docs(pairs), 4, 12)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute(pairs, 12)


def test_spans_are_maximal(spark, docs):
    shared = " ".join(f"s{i}" for i in range(50))
    frame = docs([(1, f"a b {shared} c"), (2, f"{shared} d"), (3, "nothing here")])
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in substring.repeated_texts(frame).collect()}
    assert found == {1: [(2, 52)], 2: [(0, 50)]}
    kept = {r.doc_id: r.kept_text for r in substring.without_repeats(substring.repeated_texts(frame)).collect()}
    assert kept == {1: "a b c", 2: "d"}


def test_every_window_has_an_anchor():
    rnd = np.random.default_rng(1)
    for n in (9, 20, 400):
        words = substring.Words(b"", np.zeros(n), np.zeros(n), np.array([0, n // 2, n]))
        seeds = rnd.integers(1, 50, n - 3, dtype=np.uint64)
        starts, least, chosen = substring._anchors(words, seeds, 4, 9)
        for s, m in zip(starts, least, strict=True):
            at = [i for i in range(s, s + 6) if seeds[i] == seeds[s:s + 6].min()]
            assert m == seeds[at[0]] and all(chosen[i] for i in at)


def test_parameters(docs):
    with pytest.raises(ValueError):
        substring.repeated_texts(docs([]), seed_words=9, length=8)
