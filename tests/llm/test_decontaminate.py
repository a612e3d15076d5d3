import random
import re

import numpy as np
import pytest

from shelfmark.llm import decontaminate as d


def words_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(pairs, items, length):
    phrases = {}
    for item, text in items:
        w = words_of(text)
        for s in range(max(len(w) - length, 0) + 1 if w else 0):
            phrases.setdefault(tuple(w[s:s + length]), set()).add("" if item is None else str(item))
    out = []
    for i, text in pairs:
        w, hit, found = words_of(text), set(), set()
        for s in range(len(w)):
            for n in range(1, length + 1):
                if tuple(w[s:s + n]) in phrases and s + n <= len(w):
                    hit |= set(range(s, s + n))
                    found |= phrases[tuple(w[s:s + n])]
        out.append((i, len(w), len(hit), len(found), sorted(found)))
    return sorted(out, key=str)


def report(marked):
    return sorted(((r.doc_id, r.n_words, sum(s["stop"] - s["first"] for s in r.spans), len(r["items"]), list(r["items"]))
                   for r in marked.collect()), key=str)


@pytest.fixture()
def benchmark(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize("length, block", [(3, 200_000), (3, 60), (10, 200_000)])
def test_equals_brute_force(spark, docs, clashing, benchmark, length, block):
    rnd = random.Random(length)
    vocabulary = ["the", "Ñame", "été", "a", "of", "x9", "日本", "don"]
    text = lambda n: "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "\n", "-", "'"]) for _ in range(n))
    items = [(k, text(rnd.randrange(0, 14))) for k in range(25)] + [(3, "repeated id the a"), (None, "of x9 of"), (77, None)]
    pairs = [(k, text(rnd.randrange(0, 60))) for k in range(50)]
    pairs += [(100 + k, f"{text(4)} {t} {text(3)}") for k, (_, t) in enumerate(items)]
    pairs += [(None, items[0][1]), (5, "the the"), (6, None), (7, ""), (8, "..."), (9, items[2][1].upper()), (9, items[2][1].upper())]
    extra = {k: v for k, v in clashing.items() if k not in ("n_words", "spans", "items")}
    got = report(d.contamination(docs(pairs, **extra), benchmark(items), length, block))
    assert got == brute(pairs, items, length)


def test_empty_tables(docs, benchmark):
    assert d.contamination_report(docs([]), benchmark([(1, "a b c")])).count() == 0
    only = d.contamination_report(docs([(1, "a b c")]), benchmark([])).first()
    assert (only.n_words, only.n_hit, only.contaminated) == (3, 0, False)


def test_cut_leaves_the_rest_as_it_was(docs, benchmark, clashing):
    item = "one two three four five six seven eight nine ten eleven"
    pairs = [(1, f"Before, (it) — {item.title()}!  After."), (2, "Untouched  text\n."), (3, None), (4, item)]
    cut = d.without_benchmark(docs(pairs, **clashing), benchmark([(1, item)]))
    assert cut.columns == docs(pairs, **clashing).columns
    assert {r.doc_id: r.text for r in cut.collect()} == {
        1: "Before, (it) —\n!  After.", 2: "Untouched  text\n.", 3: None, 4: "\n"}
    assert {r.row for r in cut.collect()} == {"x"}


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_index(seed):
    rnd = np.random.default_rng(seed)
    n, symbols = int(rnd.integers(1, 300)), int(rnd.integers(1, 5))
    text = rnd.integers(0, symbols + 1, n)
    unique = np.append(text, -1)
    assert d.suffix_array(unique + 1).tolist() == sorted(range(n + 1), key=lambda i: unique[i:].tolist())
    index = d.FMIndex(text, symbols, sample=int(rnd.integers(1, 9)))
    phrases = d.Phrases([(" ".join(str(c) for c in rnd.integers(1, symbols + 1, rnd.integers(1, 4))), ["i"]) for _ in range(20)])
    phrases.flat = np.array([int(w) for w in sorted(phrases.codes, key=phrases.codes.get)])[phrases.flat - 1]
    low, high = index.search(phrases)
    for k in range(20):
        p = phrases.flat[phrases.first[k]:phrases.first[k] + phrases.lengths[k]].tolist()
        want = [i for i in range(n) if text[i:i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == want


def test_wavelet_tree_ranks():
    rnd = np.random.default_rng(0)
    sequence = rnd.integers(0, 21, 500)
    tree = d.WaveletTree(sequence, 5)
    symbols, places = rnd.integers(0, 21, 200), rnd.integers(0, 501, 200)
    assert tree.rank(symbols, places).tolist() == [(sequence[:p] == s).sum() for s, p in zip(symbols, places, strict=True)]
