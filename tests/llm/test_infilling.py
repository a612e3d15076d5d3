import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import infilling


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(i, text, unit=None):
    text, d = text or "", sha(f"1:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(d[8 * k:8 * k + 8], 16) for k in range(4))
    units = [m.group(0) for m in re.finditer(f"(?:{unit})|(?s:.)" if unit else "(?s:.)", text)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made_texts():
    rnd = random.Random(4)
    signs = ["a", "é", "日", "\U0001f600", " ", "\n", "é", "<", ">", "<P", "S>", "M>", "\x00", "`", "‍"]
    return [None, "", "a", "x<P>y", "<M>", "<<P", "ab<S>", "abc " * 5000] + [
        "".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 200))) for _ in range(120)]


@pytest.mark.parametrize("unit", [None, r"\S+\s*", "[a-z]+"])
def test_equals_brute_force(docs, clashing, unit):
    pairs = [(7 * i, t) for i, t in enumerate(made_texts())] + [(None, "no id"), (None, "no id"), (14, "again"), (14, "again")]
    frame = docs(pairs, **clashing, n="x", form="x", output="x", draws="x")
    out = infilling.infilled(frame, unit=unit)
    assert set(out.columns) == {*frame.columns, "prefix_chars", "middle_chars"}
    back = infilling.restored(F.col("output"), F.col("form"))
    got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect()), key=str)
    assert got == sorted(((i, t, *brute(i, t, unit)) for i, t in pairs), key=str)
    assert out.filter(back != F.coalesce("text", F.lit(""))).isEmpty()
    assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_skip_list_finds_every_rank():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 10, 97, 1000):
        widths = rng.integers(1, 9, n)
        units = infilling.SkipList(widths, infilling.heights_of(max(n, 1)))
        before = [0, *np.cumsum(widths).tolist()]
        assert [units.place(rank) for rank in range(n + 1)] == before
        assert units.place(n + 5) == before[-1]


def test_lanes_thin_out():
    units = infilling.SkipList(np.ones(100_000, dtype=np.int64), infilling.heights_of(100_000))
    sizes = [len(lane[0]) for lane in units.lanes]
    assert sizes[0] == 100_000 and sizes[-1] == 1 and all(a > b for a, b in zip(sizes, sizes[1:], strict=False))
    assert 0.2 < sizes[1] / sizes[0] < 0.3 and len(sizes) < 16
    assert all(lane[0].sum() == 100_000 for lane in units.lanes)


def test_report(docs):
    pairs = [(i, t) for i, t in enumerate(made_texts())]
    got = {r.doc_id: tuple(r)[1:] for r in infilling.infilling_report(docs(pairs)).collect()}
    for i, t in pairs:
        n, form, a, b, out = brute(i, t)
        assert got[i] == (n, form, a, b, sha(out), sha(t or ""))


def test_other_signs(docs):
    signs = ("[pre]", "{suf}", "(mid)")
    out = infilling.infilled(docs([(i, f"text of {i} [pre") for i in range(60)]), signs)
    assert out.filter(infilling.restored(F.col("output"), F.col("form"), signs) != F.col("text")).isEmpty()
    for bad in (("<a>", "<a>", "<c>"), ("<a>", "a>", "<c>"), ("", "b", "c"), ("aa", "b", "c")):
        with pytest.raises(ValueError):
            infilling.infilled(docs([(1, "x")]), bad)


def test_empty_table(docs):
    assert infilling.infilling_report(docs([])).count() == 0
