import datetime
import gzip

import pytest
from pyspark.sql import functions as F

from shelfmark.sources import delimited, feeds, pages
from shelfmark.sources.ledger import Ledger, ledger_latest
from shelfmark.sources.tables import Store, is_empty, read_by_pattern
from shelfmark.streaming import ingest

NOW = datetime.datetime(2016, 5, 1, 10)


def test_isbn_feed(spark, tmp_path, rows):
    xml = (
        '<feed><work workcode="1"><isbn>0306406152</isbn><isbn uncertain="true">0471958697</isbn></work>\n'
        '<work workcode="2"><isbn>9780000000001</isbn><isbn>123</isbn><isbn>0306406152</isbn></work></feed>'
    )
    path = tmp_path / "feed.xml.gz"
    path.write_bytes(gzip.compress(xml.encode()))
    got = feeds.read_isbn_feed(spark, str(path))
    assert rows(got) == [
        (1, "0306406152", "0306406152", "9780306406157"),
        (2, "0306406152", "0306406152", "9780306406157"),
        (2, "9780000000001", "", "9780000000001"),
    ]
    assert feeds.read_isbn_feed(spark, str(path), max_rows=1).count() == 1


def test_headered_dump(spark, tmp_path, rows):
    path = tmp_path / "a.dat"
    path.write_text('title|work_refid|review\n"A ""q""|x"|1|"two\nlines"\n|2|""\n\\N|3|z\n')
    got = delimited.read_headered_dump(spark, str(path), ("work_refid", "title", "review", "username"))
    assert rows(got) == [("1", 'A "q"|x', "two\nlines", None), ("2", None, "", None), ("3", None, "z", None)]
    with pytest.raises(delimited.UnknownColumns):
        delimited.read_headered_dump(spark, str(path), ("work_refid", "title"))
    assert delimited.typed(got).schema["work_refid"].dataType.simpleString() == "bigint"


def test_headers_of_many_files(spark, tmp_path, rows):
    """Three layouts over many files, odd names, packed and empty files among them."""
    layouts = ("a|b", "b|a", '"a"|c')
    for i in range(60):
        cells = {"a": f"a{i}", "b": f"b{i}", "c": f"c{i}"}
        names = layouts[i % 3].replace('"', "").split("|")
        text = layouts[i % 3] + "\n" + "|".join(cells[n] for n in names) + "\n"
        if i % 7 == 0:
            (tmp_path / f"part {i}%.dat.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (tmp_path / f"part {i}%é.dat").write_text(text)
    (tmp_path / "empty.dat").write_text("")
    (tmp_path / "only header.dat").write_text("c|b\n")
    found = delimited._headers(spark, str(tmp_path))
    assert {k: len(v) for k, v in found.items()} == {"a|b": 20, "b|a": 20, '"a"|c': 20, "c|b": 1}
    got = delimited.read_headered_dump(spark, str(tmp_path), ("a", "b", "c"))
    assert rows(got) == sorted([
        (f"a{i}", f"b{i}" if i % 3 < 2 else None, f"c{i}" if i % 3 == 2 else None) for i in range(60)], key=str)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 50)


def test_a_file_is_read_no_further_than_its_first_line(spark, tmp_path):
    import pyarrow as pa

    batches = iter([pa.RecordBatch.from_pydict({"x": []}), pa.RecordBatch.from_pydict({"x": [1, 2]}), "never looked at"])
    assert [b.to_pydict() for b in delimited._first_rows(batches)] == [{"x": [1]}]
    assert list(batches) == ["never looked at"]
    (tmp_path / "long.dat").write_text("a\n" + "x\n" * 2_000_000)
    assert list(delimited._headers(spark, str(tmp_path))) == ["a"]


def test_empty_input(spark, tmp_path):
    path = tmp_path / "empty.dat"
    path.write_text("work_refid|title\n")
    assert is_empty(delimited.read_headered_dump(spark, str(path), ("work_refid", "title")))


def test_plain_dump_and_language_ref(spark, tmp_path, rows):
    plain = tmp_path / "p.csv"
    plain.write_text('1|"a|\\N|b\n')
    assert rows(delimited.read_plain_dump(spark, str(plain), ("w", "x", "y", "z"))) == [("1", '"a', None, "b")]
    ref = tmp_path / "lang.tsv"
    ref.write_text("fra\tfre\tfr\tfre\tFrench\tFrench\tfrançais\tfrançais\n")
    loaded = delimited.load_language_ref(spark, str(ref), None)
    assert loaded.first().french_name == "français"
    other = loaded.withColumn("code", F.lit("kept"))
    assert delimited.load_language_ref(spark, "/nowhere", other).first().code == "kept"


def test_export_and_tolerant_read(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(1, "a|b\\n\nc\t", None), (2, "\\N?", "x")], "id bigint, review string, lang string"
    )
    path = str(tmp_path / "out")
    delimited.export_delimited(df, path, {"review": " "}, compress=True)
    back = delimited.read_tolerant(spark, path, "id bigint, review string, lang string")
    assert rows(back) == [(1, "a b\\n\nc\t", None), (2, "\\N?", "x")]
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "f.txt").write_text("1|a|b\nnonsense|x|y\n2|c|d\n")
    assert delimited.read_tolerant(spark, str(bad), "id bigint, a string, b string", 1).count() == 2
    with pytest.raises(delimited.TooManyBadRows):
        delimited.read_tolerant(spark, str(bad), "id bigint, a string, b string", 0)


def test_every_character_comes_back(spark, tmp_path):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, points[i:i + 9001])) for i in range(0, len(points), 9001)]
    texts += ["\ue000", "\\\ue000\\", "\\", "\\\\n", "\\n\n", "|\\|", "\\N", "", "ends with \\"]
    made = spark.createDataFrame(list(enumerate(texts)), "id int, review string")
    delimited.export_delimited(made, str(tmp_path / "out"))
    back, rejects, bad = delimited.read_with_rejects(spark, str(tmp_path / "out"), "id int, review string")
    assert [r.review for r in back.orderBy("id").collect()] == texts
    assert bad == 0 and rejects.isEmpty()


def test_rejects_tell_reason_and_place(spark, tmp_path, rows):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.txt").write_text("1|2.50|x|2015-01-01\n1|2.50\none|2|x|\\N\n")
    (folder / "b.txt").write_text("3|high|y|2015-13-01\n\\N|\\N|\\N|\\N\n4|1|a\\|b|2015-01-02\n\n")
    schema = "id int, price decimal(10,2), name string, `the day` date"
    good, rejects, bad = delimited.read_with_rejects(spark, str(folder), schema)
    assert bad == 4 and rows(good, "id", "name") == [(1, "x"), (4, "a|b"), (None, None)]
    assert rows(rejects, "field", "reason", "line", "block") == sorted([
        (None, delimited.WRONG_COUNT, "1|2.50", 0), ("id", delimited.WRONG_VALUE, "one|2|x|\\N", 0),
        ("price", delimited.WRONG_VALUE, "3|high|y|2015-13-01", 0), (None, delimited.WRONG_COUNT, "", 0)], key=str)
    assert {r.source.rsplit("/", 1)[1] for r in rejects.collect()} == {"a.txt", "b.txt"}
    assert good.columns == ["id", "price", "name", "the day"]


def test_period_and_patterns(spark, tmp_path, rows):
    names = ["ReviewOf_1-1-2000_31-12-2001.dat", "ReviewOfx_5-6-2015.dat", "other.dat"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [tuple(r.p) for r in df.select(feeds.period_of("n").alias("p")).collect()]
    d = datetime.date
    assert got == [(d(2000, 1, 1), d(2001, 12, 31)), (None, d(2015, 6, 5)), (None, None)]
    (tmp_path / "sub").mkdir()
    for p in (tmp_path / names[0], tmp_path / "sub" / names[1], tmp_path / "x.csv"):
        p.write_text("a\n1\n")
    assert rows(read_by_pattern(spark, str(tmp_path), "*.dat"), "file_name") == [(names[0],)]
    assert read_by_pattern(spark, str(tmp_path), "*.dat", recursive=True).count() == 2
    read = feeds.with_period(spark.read.option("header", True).csv(str(tmp_path / names[0])))
    assert read.first().period.end == d(2001, 12, 31)


def test_listing(spark, tmp_path, rows):
    ok = ('({"total":"3","data":[{"id":"100","titre":"Harbour","nbrcrit":"1","auteurstring":"Dalmont, Irène"},\n'
          '{"id":"200","titre":"Le phare","nbrcrit":"3","auteurstring":"Oriel, Basile"}],"success":0,"message":""})\n')
    (tmp_path / "list.json").write_text(ok)
    got = feeds.read_listing_json(spark, str(tmp_path / "list.json"))
    assert rows(got) == [("200", "Le phare", 2, "Basile", "Oriel")]
    (tmp_path / "bad.json").write_text('({"total":"0","data":[],"success":1,"message":"down"})')
    with pytest.raises(Exception, match="down"):
        feeds.read_listing_json(spark, str(tmp_path / "bad.json")).collect()


def test_store_and_ledger(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path / "wh"))
    store.replace("t", spark.range(3).toDF("id"))
    store.replace("t", store.read("t").filter("id > 0"))
    assert rows(store.read("t")) == [(1,), (2,)]
    ledger = Ledger(spark, str(tmp_path / "audit"))
    seen = []

    def step(batch):
        seen.append(batch)
        store.append_batch("r", spark.range(2).select("id", F.lit(batch).alias("load_audit_id")))
        return 2

    assert ledger.run("job", "a", step, NOW) == "Completed"
    assert ledger.run("job", "a", step, NOW) == "Skipped"
    assert seen == [1] and store.read("r").count() == 2

    def fails(batch):
        seen.append(batch)
        store.append_batch("r", spark.range(5).select("id", F.lit(batch).alias("load_audit_id")))
        raise ValueError("broken")

    with pytest.raises(ValueError):
        ledger.run("job", "b", fails, NOW)
    assert ledger.run("job", "b", step, NOW) == "Completed"
    assert seen == [1, 2, 2] and store.read("r").count() == 4
    assert ledger.run("job", "c", lambda b: None, NOW) == "Empty"
    latest = {r.step_name: r.status for r in ledger_latest(ledger.read()).collect()}
    assert latest == {"a": "Completed", "b": "Completed", "c": "Empty"}
    store.drop_batch("r", 2)
    assert store.read("r").count() == 2


def test_versions_are_kept_short_and_a_broken_one_is_not_the_table(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    for n in range(1, 6):
        store.replace("t", spark.range(n).toDF("id"))
    folder = tmp_path / "t"
    assert len(list(folder.iterdir())) == 2
    (folder / "v-000000099-broken").mkdir()
    assert store.read("t").count() == 5


def test_two_jobs_at_once_get_different_load_ids(spark, tmp_path):
    one, two = Ledger(spark, str(tmp_path / "audit")), Ledger(spark, str(tmp_path / "audit"))
    seen = []

    def outer(batch):
        seen.append(batch)
        two.run("job two", "a", lambda b: seen.append(b) or 1, NOW)
        return 1

    first = one._claim(0)
    one.run("job one", "a", outer, NOW)
    assert len({first, *seen}) == 3


def test_two_header_orders(spark, tmp_path, rows):
    (tmp_path / "a.dat").write_text("work_refid|title\n1|one\n")
    (tmp_path / "b.dat").write_text("title|work_refid\ntwo|2\n")
    (tmp_path / "c.dat.gz").write_bytes(gzip.compress(b"title|work_refid\nthree|3\n"))
    got = delimited.read_headered_dump(spark, str(tmp_path), ("work_refid", "title"))
    assert rows(got) == [("1", "one"), ("2", "two"), ("3", "three")]


def test_replace_partition_leaves_other_sites(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    store.replace_partition("r", spark.createDataFrame([(1, "a"), (2, "b")], "id int, site string"), "site")
    store.replace_partition("r", spark.createDataFrame([(3, "b")], "id int, site string"), "site")
    assert rows(store.read("r")) == [(1, "a"), (3, "b")]


def test_ingest_takes_each_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.dat").write_text("a|b\n1|x\n")
    store = Store(spark, str(tmp_path / "wh"))
    ledger = Ledger(spark, str(tmp_path / "audit"))
    ledger.run("other job", "a", lambda b: 1, NOW)
    args = (spark, str(folder), ("a", "b"), str(tmp_path / "ck"), ingest.into_store(store, "t", ledger, "ingest", NOW))
    ingest.ingest_dumps(*args)
    (folder / "2.dat").write_text('a|b\n2|"y\nz"\n')
    ingest.ingest_dumps(*args)
    ingest.ingest_dumps(*args)
    assert sorted((r.a, r.b, r.load_audit_id) for r in store.read("t").collect()) == [("1", "x", 2), ("2", "y\nz", 3)]


LT = """<div class="tags"><span><a>sea tales</a> <span class="count">(1)</span></span><span><a>Bergen</a>
<span class="count"> (12)</span></span></div>
<div class="bookReview"><div class="commentText">Très bien &amp; bon.<br>Suite <span class="rating">( <img
src="http://pics.example/pics/ss10.gif"> )</span></div><div class="commentFooter"><span class="reviewVoteCount">1</span>
<span class="controlItems"><a href="/profile/quillon">quillon</a> | Mar 4, 2011 |  <a href="/review/9">x</a></span></div></div>
<div class="bookReview"><div class="commentText">Second</div><div class="commentFooter">
<span class="reviewVoteCount">&nbsp;</span><span class="controlItems"><a href="/profile/ann">ann</a> |  |  </span></div></div>"""

CL = """<p><strong>Le livre</strong></p><table width="100%"  border="0" cellspacing="0" cellpadding="3">
<tr><td class="titre">t</td><td class="texte"><img alt="9 etoiles" name="9 etoiles"></td></tr>
<tr><td colspan="2" class="texte"><p>Texte un</p><p><a href="/i.php/vuser/?uid=3f20a77b91d4">Nils</a> -  - 44 ans - 7 juin 2014</p></td></tr>
<tr align="center"><td><hr></td></tr>
<tr><td class="titre">t</td><td class="texte"><img name="10 etoiles"></td></tr>
<tr><td class="texte"><p>Texte deux</p><p><a href="/i.php/vuser/?uid=77ab">F2</a> -  - 61 ans - 3 mai 2009</p></td></tr>
<tr><td><hr></td></tr></table>"""


def test_review_pages(spark):
    df = spark.createDataFrame(
        [("https://www.librarything.com/work/4410077", LT), ("http://www.critiqueslibres.com/i.php/vcrit/200?alt=print", CL),
         ("https://www.goodreads.com/book/show/5?page=1", "<p>nothing</p>"), ("https://elsewhere.example/", LT)],
        "url string, html string",
    )
    got = {(r.site_logical_name, r.nth): r for r in pages.extract_reviews(df).collect()}
    assert len(got) == 5
    first, second = got[("librarything", 0)], got[("librarything", 1)]
    assert (first.user_uid, first.parsed_rating, first.parsed_likes) == ("quillon", 10, 1)
    assert first.parsed_review_date == datetime.date(2011, 3, 4)
    assert first.review.startswith("Très bien & bon.") and "(   )" not in first.review
    assert (first.tags_t, first.tags_n, first.tags_lang) == ("sea tales__&__Bergen", "1;12", "eng")
    assert (second.parsed_rating, second.parsed_likes, second.parsed_review_date) == (None, None, None)
    cl = got[("critiqueslibres", 0)]
    assert (cl.user_uid, cl.username, cl.parsed_rating, cl.review) == ("3f20a77b91d4", "Nils", 9, "Texte un")
    assert cl.parsed_review_date == datetime.date(2014, 6, 7)
    assert got[("critiqueslibres", 1)].parsed_rating == 10
    none = got[("goodreads", None)]
    assert none.work_uid == "5" and none.review is None


def test_pages_of_one_file_are_taken_apart_in_many_tasks(spark):
    """Stored pages are few bytes in few files; the parsing is dealt out whatever their layout."""
    details = [(str(i), f"https://www.librarything.com/work/{i}/workdetails", "<div>x</div>") for i in range(64)]
    df = spark.createDataFrame(details, "requested_refid string, url string, html string").coalesce(1)
    done = pages.extract_work_details(df).select("work_refid", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.work_refid for r in done) == list(range(64)) and len({r.task for r in done}) > 4
    reviews = df.withColumn("url", F.replace("url", F.lit("details"), F.lit("/reviews")))
    assert reviews.count() == pages.raw_reviews(reviews).count()
    assert pages.raw_reviews(reviews).select(F.spark_partition_id()).distinct().count() > 4
