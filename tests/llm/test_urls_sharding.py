import random
import zlib

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import sharding, urls
from shelfmark.llm.queries import URL_RULES


@pytest.mark.parametrize("url, host, path", [
    ("https://A.Example.COM/en/x?q#f", "a.example.com", "/en/x"), ("http://h", "h", ""), ("http://h?x://y/z", "h", ""),
    ("h/path", "", ""), (None, "", ""), ("://", "", ""), ("a://b://c/d", "b:", "//c/d"), ("x://É.com/\n/a#b", "É.com", "/\n/a"),
    ("", "", ""), ("ftp://u@h:8/p?q", "u@h:8", "/p"),
])
def test_split(spark, url, host, path):
    frame = spark.createDataFrame([(url,)], "url string")
    assert tuple(frame.select(urls.url_host(F.col("url")), urls.url_path(F.col("url"))).first()) == (host, path)


@pytest.fixture()
def judged(spark):
    def run(pages, labels, **extra):
        columns = "page_id bigint, url string" + "".join(f", `{k}` string" for k in extra)
        frame = spark.createDataFrame([(*p, *extra.values()) for p in pages], columns)
        marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
        return {r.page_id: r for r in urls.judged_pages(frame, marks, URL_RULES).collect()}

    return run


def test_rules(judged):
    got = judged([(1, "http://example.com/en/1"), (2, "http://www.example.com/en/1"), (3, "http://a.www.example.com/de/1"),
                  (4, "http://x.net/es/2"), (5, "http://x.net/de/2"), (6, "http://com"), (7, "http://notexample.com/en/1"),
                  (8, "http://example.com"), (9, None), (10, "http://xnet/es/1")], [])
    assert {k: r.rule for k, r in got.items()} == {
        1: "example.com/en/", 2: "www.example.com/en/", 3: "com/", 4: "net/es/", 5: None, 6: None, 7: "com/", 8: None, 9: None, 10: None}
    assert {k: r.verdict for k, r in got.items() if r.rule} == {1: "block", 2: "allow", 3: "allow", 4: "block", 7: "allow"}


def test_reputation_follows_the_labels_and_shrinks(judged):
    pages, labels = [], []
    n = 0
    for host, good, bad in (("good.a.org", 300, 2), ("bad.a.org", 2, 300), ("good.b.org", 200, 0), ("few.c.org", 1, 0)):
        for mark in [1] * good + [0] * bad:
            n += 1
            pages.append((n, f"http://{host}/en/{n}"))
            labels.append((n, mark))
    pages += [(n + 1, "http://new.a.org/en/x"), (n + 2, "http://new.b.org/en/999999")]
    got = judged(pages, labels, host="x", rule="y", good="z")
    by_host = {r.host: r for r in got.values()}
    assert by_host["good.a.org"].verdict == "allow" and by_host["bad.a.org"].verdict == "block"
    assert by_host["good.a.org"].rate > by_host["new.a.org"].rate > by_host["bad.a.org"].rate
    assert by_host["few.c.org"].rate < by_host["good.b.org"].rate
    assert by_host["new.b.org"].rate > by_host["new.a.org"].rate


def test_odd_labels_and_empty_tables(judged):
    got = judged([(1, "http://a.org/en/1"), (1, "http://a.org/en/1"), (None, "http://b.org/en/2")],
                 [(1, 0), (1, 1), (2, None), (None, 1), (2, 5)])
    assert {r.rate for r in got.values()} == {0.5}
    assert judged([], []) == {}


def test_plan_has_no_python(spark):
    frame = spark.createDataFrame([(1, "http://a.org/en/1")], "page_id bigint, url string")
    plan = urls.judged_pages(frame, spark.createDataFrame([(1, 1)], "doc_id bigint, quality int"), URL_RULES)
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_shards(docs, clashing, shards):
    rnd = random.Random(shards)
    pairs = [(rnd.randrange(100_000), "é" * rnd.randrange(300)) for _ in range(400)] + [(5, None), (None, "x"), (5, ""), (None, None)]
    pairs += [(7, "same")] * 100
    got = sharding.sharded(docs(pairs, **{k: v for k, v in clashing.items() if k != "text_crc32"}), shards).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), size(t), zlib.crc32((t or "").encode())) for i, t in pairs)
    got.sort(key=lambda r: (r.shard, r.slot))
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    share, largest = sum(r.size for r in got) / shards, max(r.size for r in got)
    for s in range(shards):
        own = [r for r in got if r.shard == s]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - share) <= largest


def test_no_rows(docs):
    assert sharding.sharded(docs([])).count() == 0
