import datetime

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.similarity import NothingPending
from shelfmark.plans.flows import Warehouse

NOW = datetime.datetime(2016, 5, 1, 10)


def write(path, header, lines):
    path.write_text(header + "\n" + "\n".join(lines) + "\n")
    return str(path)


def test_from_files_to_star_schema(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.store.replace("site", spark.createDataFrame(
        [(1, "librarything"), (2, "goodreads"), (4, "babelio")], "id int, logical_name string"))
    wh.store.replace("site_identifier", spark.createDataFrame(
        [(1, "a.example"), (2, "b.example"), (4, "c.example")], "site_id int, hostname string"))
    wh.store.replace("language", spark.createDataFrame(
        [("fre", "fra", "fre", "fr", "French", "French", "français", "français")],
        "code string, code3 string, code3_term string, code2 string, english_name string, "
        "english_iso_name string, french_name string, french_iso_name string"))

    feed = tmp_path / "feed.xml"
    feed.write_text('<f><work workcode="1"><isbn>0306406152</isbn></work><work workcode="2"><isbn>0471958697</isbn></work></f>')
    wh.load_isbn_feed(str(feed), "feed-1", NOW)
    wh.load_isbn_feed(str(feed), "feed-1", NOW)
    assert wh.table("work").count() == 2 and wh.table("work_isbn").count() == 2

    info = write(
        tmp_path / "info.dat",
        "work_refid|title|authors|authors_code|mds_code|mds_text|popularity|other_lang_title|ori_lang_code|dup_refid",
        ["1|Book one|Ann Lee|leeann|813.6|L-->F|1,200|French : Livre un|eng|", "2|Book two|Bo|bo||||| |".replace("| |", "||")],
    )
    wh.load_work_info(info, "info-1", NOW)
    assert wh.table("work_info").count() == 2 and wh.table("work_title").count() == 1

    text = " ".join(["This is a long review of a good book about the sea and the people"] * 3)
    header = "site_logical_name|username|user_uid|work_refid|work_uid|review|review_lang|parsed_rating|parsed_review_date|tags_t|tags_n"
    gr = write(tmp_path / "gr.dat", header, [
        f"goodreads|Ann|u1|1|g1|{text}|eng|8|2015-01-01|sea stories__&__x|3;1",
        f"goodreads|Bob|u2|1|g1|{text} Yes|eng|6|2015-01-02|sea stories__&__x|3;1",
    ])
    ba = write(tmp_path / "ba.dat", header, [f"babelio|Cid|u1|1|b1|{text}|eng|4|2015-02-01||"])
    lt = write(tmp_path / "lt.dat", header, ["librarything|zoe|zoe|1||other|eng|10|2014-01-01||"])
    for path, site in ((gr, "goodreads"), (ba, "babelio"), (lt, "librarything")):
        wh.load_reviews(path, site, f"{site}-1", NOW)
    wh.load_reviews(gr, "goodreads", "goodreads-1", NOW)
    assert wh.table("review").count() == 4
    assert wh.table("review").select("id").distinct().count() == 4
    assert wh.table("user").count() == 4 and wh.table("work_site_mapping").count() == 2
    assert wh.table("tag").count() == 2 and wh.table("work_tag").count() == 2

    wh.process_similarity("s-1", NOW)
    similar = wh.table("review_similarto").collect()
    assert len(similar) == 2 and len({r.other_review_id for r in similar}) == 1
    with pytest.raises(NothingPending):
        wh.process_similarity("s-2", NOW)

    wh.store.replace("city", spark.createDataFrame(
        [("Aville", 900, 1.0, 2.0), ("Btown", 100, 3.0, 4.0)], "city string, pop bigint, lat double, long double"))
    wh.build_star("s-1", NOW)
    assert {r.city for r in wh.store.read("dim_reviewer").collect()} <= {"Aville", "Btown"}
    assert wh.store.read("dim_reviewer").count() == 4
    exported = wh.export_star(str(tmp_path / "export"))
    assert len(exported) == 11
    assert spark.read.text(str(tmp_path / "export" / "fact_review")).count() == 4
    fact = wh.store.read("fact_review")
    assert fact.count() == 4 and fact.filter("similarto_id is not null").count() == 2
    assert wh.store.read("dim_book").count() == 2
    assert wh.store.read("dim_book").filter("book_id = 1").first().french_title == "Livre un"
    assert wh.store.read("dim_tag").first().tag_name == "SEA STORIES"
    assert wh.store.read("rel_author").count() == 2


INFO = "work_refid|title|authors|authors_code|mds_code|mds_text|popularity|other_lang_title|ori_lang_code|dup_refid"
REVIEWS = "site_logical_name|username|user_uid|work_refid|work_uid|review|review_lang|parsed_rating|parsed_review_date"


def house(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.store.replace("site", spark.createDataFrame(
        [(1, "librarything"), (2, "goodreads"), (4, "babelio")], "id int, logical_name string"))
    return wh


def test_an_empty_dump_loads_nothing_again(spark, tmp_path):
    wh = house(spark, tmp_path)
    full = write(tmp_path / "r1.dat", REVIEWS, [
        "goodreads|Ann|u1|1|g1|good|eng|8|2015-01-01", "goodreads|Bob|u2|1|g1|bad|eng|2|2015-01-02"])
    empty = write(tmp_path / "r2.dat", REVIEWS, [])
    wh.load_reviews(full, "goodreads", "one", NOW)
    wh.load_reviews(empty, "goodreads", "two", NOW + datetime.timedelta(days=1))
    assert wh.table("review").count() == 2
    assert {r.last_seen_date for r in wh.table("user").collect()} == {NOW.date()}
    wh.load_work_info(write(tmp_path / "i1.dat", INFO, ["1|One|Ann|ann|8.13|x|1||eng|"]), "one", NOW)
    wh.load_work_info(write(tmp_path / "i2.dat", INFO, []), "two", NOW)
    assert wh.table("work_info").count() == 1
    feed = tmp_path / "feed.xml"
    feed.write_text('<f><work workcode="1"><isbn>0306406152</isbn></work></f>')
    wh.load_isbn_feed(str(feed), "one", NOW)
    feed.write_text("<f></f>")
    wh.load_isbn_feed(str(feed), "two", NOW + datetime.timedelta(days=1))
    assert wh.table("work_isbn").filter("deletion_date is null").count() == 1


def test_a_repeated_insert_load_holds_its_whole_stage(spark, tmp_path, rows):
    from shelfmark.operators import loads

    wh = house(spark, tmp_path)

    def load(codes):
        stage = spark.createDataFrame([(1, c) for c in codes], "work_refid bigint, authors_code string")
        return wh._append("author", loads.insert_author(wh.before("author", 1), stage, NOW.isoformat(sep=" "), 1), 1)

    assert load(["a", "b"]) == 2
    assert load(["a", "b", "c"]) == 3
    assert rows(wh.table("author"), "code") == [("a",), ("b",), ("c",)]
    assert load([]) == 0
    assert wh.table("author").count() == 0


def test_keys_are_unique(spark, tmp_path, rows):
    wh = house(spark, tmp_path)
    wh.load_work_info(write(tmp_path / "i.dat", INFO, [
        "1|One|Ann|ann|8.13|x|1|French : Un__&__French : Une|eng|", "2|Two|Bo|bo|81.3|y|1||eng|",
        "1|One more|Ann|ann|8.13|x|1||eng|"]), "one", NOW)
    assert rows(wh.table("mds"), "code", "code_w_dot", "mds_text") == [("813", "81.3", "y")]
    assert rows(wh.table("work_info"), "work_refid", "title") == [(1, "One more"), (2, "Two")]
    assert rows(wh.table("work_title"), "work_refid", "lang_text", "title") == [(1, "French", "Une")]
    from shelfmark.operators import loads
    from shelfmark.plans.tables import SCHEMAS

    feed = spark.createDataFrame(
        [(1, "9780306406157", "0306406152"), (2, "09780306406157", "")], "work_refid bigint, isbn13 string, isbn10 string")
    isbn = loads.merge_isbn(spark.createDataFrame([], SCHEMAS["isbn"]), feed, NOW.isoformat(sep=" "), 1)
    assert rows(isbn, "ean") == [(9780306406157,)]
    assert loads.unambiguous_isbns(feed).count() == 0


def test_intermediate_tables_go_after_a_step(spark, tmp_path):
    wh = house(spark, tmp_path)
    text = " ".join(["This is a long review of a good book about the sea and the people"] * 3)
    path = write(tmp_path / "r.dat", REVIEWS, [
        f"goodreads|Ann|u1|1|g1|{text}|eng|8|2015-01-01", f"goodreads|Bob|u2|1|g1|{text} Yes|eng|2|2015-01-02"])
    wh.load_reviews(path, "goodreads", "one", NOW)
    wh.store.replace("rev_similarto_process", wh.table("review").selectExpr(
        "work_refid", "id as review_id", "length(review) as text_length", "review_lang",
        "cast(null as timestamp_ntz) as date_processed", "7 as load_audit_id"))
    from shelfmark.operators import similarity
    from shelfmark.sources.tables import drop_intermediate

    drop_intermediate(spark)
    assert similarity.pick_similar(wh.table("rev_similarto_process"), wh.table("review")).count() == 1
    assert drop_intermediate(spark) > 0
    assert drop_intermediate(spark) == 0


def test_loads_append_touches_and_fold(spark, tmp_path):
    wh = house(spark, tmp_path)
    wh.load_reviews(write(tmp_path / "r1.dat", REVIEWS, [
        f"goodreads|n{i}|u{i}|{i}|g{i}|good|eng|8|2015-01-01" for i in range(40)]), "goodreads", "one", NOW)

    def files(name):
        return {str(p) for p in (tmp_path / "wh" / name).rglob("*.parquet")}

    before = {name: files(name) for name in ("user", "work_site_mapping")}
    wh.load_reviews(write(tmp_path / "r2.dat", REVIEWS, [
        "goodreads|n3|u3|3|g3|again|eng|8|2015-02-01"]), "goodreads", "two", NOW + datetime.timedelta(days=1))
    for name, old in before.items():
        new = files(name) - old
        assert old <= files(name) and spark.read.parquet(*new).count() == 1
        assert wh.table(name).count() == 40
    seen = wh.table("user").filter(f"last_seen_date > date '{NOW.date()}'")
    assert seen.count() == 1
    assert wh.fold_touches(least=2) == {"user": 2, "work_site_mapping": 2}
    assert wh.fold_touches(least=2) == {}
    assert wh.table("user").count() == 40
    assert wh.table("user").filter(f"last_seen_date > date '{NOW.date()}'").count() == 1
    assert wh.table("review").count() == 41


def test_languages_are_loaded_once_and_filled(spark, tmp_path):
    wh = house(spark, tmp_path)
    ref = tmp_path / "lang.tsv"
    ref.write_text("fra\tfre\tfr\tfre\tFrench\tFrench\tfrançais\tfrançais\n")
    wh.load_languages(str(ref), "one", NOW)
    ref.write_text("deu\tger\tde\tger\tGerman\tGerman\tallemand\tallemand\n")
    wh.load_languages(str(ref), "two", NOW)
    assert [r.code for r in wh.table("language").collect()] == ["fre"]
    en, fr = "the story of the long night and the river house", "une histoire de la longue nuit et de la maison"
    lines = [f"goodreads|n{i}|u{i}|{i}|g{i}|{t} {i}|{lang}|8|2015-01-01"
             for i, (t, lang) in enumerate([(en, "eng"), (fr, "fre")] * 4 + [(en, ""), (fr, "")])]
    wh.load_reviews(write(tmp_path / "r.dat", REVIEWS, lines), "goodreads", "one", NOW)
    assert wh.table("review").filter("review_lang is null").count() == 2
    wh.fill_languages("one", NOW)
    assert wh.table("review").count() == 10
    assert sorted(r.review_lang for r in wh.table("review").collect()) == ["eng"] * 5 + ["fre"] * 5


def test_isbn_languages_with_rejects(spark, tmp_path, rows):
    wh = house(spark, tmp_path)
    path = write(tmp_path / "i.dat", "ean|lang_code", ["9780306406157|eng", "9780471958697|unknown", "9780000000002|error page"])
    wh.load_isbn_lang(path, "one", NOW)
    assert rows(wh.table("isbn_info"), "ean", "lang_code") == [(9780306406157, "eng"), (9780471958697, "und")]
    assert rows(wh.table("isbn_lang_rejected"), "ean", "reply") == [("9780000000002", "error page")]
    wh.export_isbns_without_lang(str(tmp_path / "ask"), 10)
    assert spark.read.text(str(tmp_path / "ask")).count() == 0


def test_a_second_build_keeps_the_ids_of_the_first(spark, tmp_path):
    wh = house(spark, tmp_path)
    wh.store.replace("site_identifier", spark.createDataFrame([(2, "b.example")], "site_id int, hostname string"))
    tagged = REVIEWS + "|tags_t|tags_n"
    tables = {"dim_tag": ("tag_name", "tag_id"), "dim_author": ("code", "author_id"), "dim_reviewer": ("reviewer_uuid", "reviewer_id")}

    def build(task, lines, works):
        wh.load_work_info(write(tmp_path / f"{task}.i", INFO, works), task, NOW)
        wh.load_reviews(write(tmp_path / f"{task}.r", tagged, lines), "goodreads", task, NOW)
        wh.build_star(task, NOW)
        return {t: {r[k]: r[i] for r in wh.store.read(t).collect()} for t, (k, i) in tables.items()}

    first = build("one", ["goodreads|Mo|u5|1|g1|good|eng|8|2015-01-01|middle__&__pear|1;1"], ["1|One|Moe|moe|8.13|x|1||eng|"])
    fact = {(r.id, r.reviewer_id) for r in wh.store.read("fact_review").collect()}
    second = build("two", ["goodreads|Al|u1|2|g2|bad|eng|2|2015-01-02|apple__&__pear__&__zebra|1;1;1",
                           "goodreads|Zed|u9|1|g1|fine|eng|4|2015-01-03||"], ["2|Two|Abe;Zoe|abe;zoe|81.3|y|1||eng|"])
    for name, ids in first.items():
        assert ids.items() <= second[name].items() and len(second[name]) == len(ids) + 2
        assert sorted(second[name].values()) == list(range(1, len(ids) + 3))
    assert fact <= {(r.id, r.reviewer_id) for r in wh.store.read("fact_review").collect()}
    assert wh.store.read("fact_review").count() == 3
    # A build that is repeated registers nothing again.
    wh.build_star("two", NOW)
    assert wh.table("tag_key").count() == len(second["dim_tag"])


def test_new_keys(spark, rows):
    from shelfmark.operators import keys

    known = spark.createDataFrame([("b", 1), ("z", 7)], "k string, id long")
    wanted = spark.createDataFrame([(k,) for k in ("c", "a", "b", "c", None, "é")], "k string")
    assert rows(keys.new_keys(known, wanted, "k", "id")) == [("a", 8), ("c", 9), ("é", 10)]
    assert rows(keys.new_keys(known.limit(0), wanted.limit(0), "k", "id")) == []
    assert rows(keys.with_ids(wanted, known, "k", "id")) == [(1, "b")]


def test_an_import_keeps_what_it_cannot_read(spark, tmp_path, rows):
    from shelfmark.sources.delimited import TooManyBadRows

    wh, folder = house(spark, tmp_path), tmp_path / "export"
    folder.mkdir()
    (folder / "f.txt").write_text("1|a\n2\nx|c\n3|d\n")
    layout = "site_id int, name string"
    with pytest.raises(TooManyBadRows):
        wh.import_table("dim_site", str(folder), layout, "one", NOW, max_errors=1)
    assert not wh.store.exists("dim_site") and wh.table("rejected").count() == 2
    wh.import_table("dim_site", str(folder), layout, "one", NOW, max_errors=2)
    assert rows(wh.store.read("dim_site")) == [(1, "a"), (3, "d")]
    assert rows(wh.table("rejected"), "reason", "line") == [("number of fields", "2"), ("value", "x|c")]


def test_report_states_follow_the_loads(spark, tmp_path, rows):
    from shelfmark.operators import standing
    from shelfmark.plans import reports

    wh = house(spark, tmp_path)
    lots = {
        "one": [f"goodreads|n{i}|u{i}|{i % 3}|g{i}|good|eng|{i % 9}|2015-01-01" for i in range(12)],
        "two": ["goodreads|n1|u1|1|g1|bad|eng|2|2015-01-02", "goodreads|n2|u2|7|g2|none|eng||2015-01-03"],
    }
    for task, lines in lots.items():
        wh.load_reviews(write(tmp_path / f"{task}.r", REVIEWS, lines), "goodreads", task, NOW)
        wh.load_reviews(write(tmp_path / f"{task}.r", REVIEWS, lines), "goodreads", task, NOW)
    wh.load_reviews(write(tmp_path / "b.r", REVIEWS, [
        f"babelio|n{i}|u{i}|{i % 4}|b{i}|ok|fre|{i}|2015-01-01" for i in range(8)]), "babelio", "three", NOW)
    sites = {"gr": 2, "ba": 4}

    def compare():
        state, reviews = wh.table("review_state"), wh.table("review")
        titles = reviews.select("work_refid").distinct().selectExpr("work_refid", "'t' as title")
        assert rows(standing.site_rating_comparison(state, sites)) == rows(reports.site_rating_comparison(reviews, sites))
        assert rows(standing.top_books(state, titles)) == rows(reports.top_books(reviews, titles))
        assert rows(standing.reviews_per_site(state, wh.table("review_readers"))) == rows(reports.reviews_per_site(reviews))
        return rows(standing.reviews_by_site(state))

    assert compare() == [(2, 14), (4, 8)]
    second = wh.table("review").filter("review = 'bad'").first().load_audit_id
    wh.take_back_reviews(second)
    assert compare() == [(2, 12), (4, 8)]


def test_patches_are_laid_over_undone_and_worked_in(spark, tmp_path, rows):
    from shelfmark.operators import overlay, repair

    wh = house(spark, tmp_path)
    loud = "THIS REVIEW IS WRITTEN ENTIRELY IN CAPITALS AND SHOUTS"
    wh.load_reviews(write(tmp_path / "a.r", REVIEWS, [
        f"babelio|n{i}|u{i}|{i}|b7|{loud if i == 3 else 'quiet words'} {i}|fre|{i}|2015-01-01" for i in range(4)]), "babelio", "one", NOW)
    wh.load_reviews(write(tmp_path / "b.r", REVIEWS, [
        "babelio|n9|u9|9|b7|of a work with a uid that others had|fre|8|2015-01-02"]), "babelio", "two", NOW)
    before = rows(wh.table("review"))
    direct = repair.drop_shared_uid_duplicates(repair.reset_lang_for_caps(wh.table("review")), wh.table("work_site_mapping"))
    direct = rows(direct.select(*wh.table("review").columns))
    assert len(direct) == 4 and len(before) == 5
    files = {p for p in (tmp_path / "wh" / "review").rglob("*.parquet")}
    wh.repair_reviews("one", NOW)
    wh.repair_reviews("one", NOW)
    assert rows(wh.table("review")) == direct and rows(wh.stored("review")) == before
    assert files == {p for p in (tmp_path / "wh" / "review").rglob("*.parquet")}
    # A later load's patch of the same column counts; without it the earlier one does again.
    shouted = wh.table("review").filter("review like 'THIS%'").select("id")
    wh._append("review_patch", overlay.value_patch(shouted, "review_lang", F.lit("eng"), 90), 90)
    assert wh.table("review").filter("review like 'THIS%'").first().review_lang == "eng"
    wh.undo_patches(90)
    assert rows(wh.table("review")) == direct
    assert wh.work_in_patches() == 2 and wh.table("review_patch").count() == 0
    assert rows(wh.table("review")) == direct and rows(wh.stored("review")) == direct
    assert rows(wh.table("review_state"), "nb_reviews") == [(1,)] * 4
    assert wh.work_in_patches() == 0
