import datetime

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import languages, normalize, queues, repair, satellites, star
from shelfmark.plans import reports


def d(text):
    return datetime.date.fromisoformat(text)


def test_period_class_bounds(spark):
    """The begin belongs to the period, the end does not."""
    dates = ["2009-12-31", "2010-01-01", "2010-01-31", "2010-02-01"]
    df = spark.createDataFrame([(d(x),) for x in dates], "day date")
    last, until = F.lit("2010-01-01").cast("date"), F.lit("2010-02-01").cast("date")
    got = [r.c for r in df.select(queues.period_class("day", last, until).alias("c")).collect()]
    assert got == [-1, 0, 0, 1]
    assert queues.within_period(df, "day", last, until).count() == 2
    assert queues.within_period(df, "day", None, until).count() == 3


def test_join_valid(spark, rows):
    facts = spark.createDataFrame(
        [(1, d("2016-01-31")), (1, d("2016-02-01")), (1, d("2016-05-01")), (2, d("2016-01-01"))],
        "user_id bigint, day date",
    )
    versions = spark.createDataFrame(
        [(1, d("2016-01-01"), "a"), (1, d("2016-02-01"), "b"), (1, d("2016-04-15"), "c")],
        "user_id bigint, valid_from date, region string",
    )
    intervals = satellites.close_intervals(versions, "user_id")
    strict = satellites.join_valid(facts, intervals, "user_id", "day", attributes=["region"])
    assert [r[2] for r in rows(strict)] == ["a", "b", None, None]
    closed = satellites.join_valid(
        facts, intervals, "user_id", "day", attributes=["region"], open_until="2017-01-01"
    )
    assert [r[2] for r in rows(closed)] == ["a", "b", "c", None]


def test_dedupe_editions(spark, rows):
    searched = spark.createDataFrame([(1,), (2,), (3,)], "work_refid bigint")
    results = spark.createDataFrame(
        [(1, 0, "A", "4.3 out of 5 stars", "1,200"), (1, 1, "B", "4.3 out of 5 stars", "1,200"),
         (1, 2, "C", "4.0 out of 5 stars", "7"), (1, 3, "D", None, None), (2, 0, "E", None, None)],
        "work_refid bigint, position int, asin string, stars string, nb_reviews string",
    )
    assert rows(normalize.dedupe_editions(searched, results)) == [(1, "A"), (1, "C"), (2, "-2"), (3, "-1")]


def test_marc_lookup(spark):
    language = spark.createDataFrame(
        [("eng", "en", "eng", "English", "anglais"), ("grc", None, "grc", "Greek (ancient)", "grec ancien"),
         ("und", None, "und", "Undetermined", "indéterminée")],
        "code string, code2 string, code3 string, english_name string, french_name string",
    )
    cases = [("English", "ENG"), (" En ", "ENG"), ("und", "UND"), ("Greek (ancient)", "GRC"), ("funny", "--"), (None, None)]
    df = spark.createDataFrame([c[:1] for c in cases], "name string")
    got = {r.name: r.marc_code for r in normalize.marc_lookup(df, "name", language).collect()}
    assert got == dict(cases)
    low = {r.name: r.marc_code for r in normalize.marc_lookup(df, "name", language, capital=False).collect()}
    assert low["English"] == "eng" and low["funny"] == "--"


def test_isbn_lang_validation(spark, rows):
    df = spark.createDataFrame([(1, "eng"), (2, "unknown"), (3, "<html>"), (4, "und")], "ean bigint, reply string")
    good, bad = normalize.validate_isbn_lang(df)
    assert rows(good) == [(1, "eng"), (2, "und"), (4, "und")] and rows(bad) == [(3, "<html>")]


def test_repairs(spark, rows):
    reviews = spark.createDataFrame(
        [(1, "X" * 40, "eng"), (2, "x" * 40, "eng"), (3, "SHORT", "eng"), (4, None, "eng"), (5, "XX" * 10 + "x" * 20, "eng")],
        "id bigint, review string, review_lang string",
    )
    assert rows(repair.reset_lang_for_caps(reviews), "id", "review_lang") == [
        (1, None), (2, "eng"), (3, "eng"), (4, "eng"), (5, "eng")
    ]
    works = spark.createDataFrame([(1, "8136"), (2, "999"), (3, None), (4, "81")], "work_refid bigint, mds_code string")
    mds = spark.createDataFrame([("81",), ("813",)], "code string")
    assert rows(repair.truncate_to_known_prefix(works, mds)) == [(1, "813"), (2, ""), (3, None), (4, "81")]


def test_language_detection(spark):
    data = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = data.filter(F.col("doc_id") % 2 == 0).select(F.col("text").alias("review"), F.col("lang").alias("review_lang"))
    test = data.filter(F.col("doc_id") % 2 == 1).select(
        F.col("doc_id").alias("id"), F.col("text").alias("review"), F.col("lang").alias("review_lang"))
    profiles = languages.train_profiles(train)
    found = languages.detect_language(test, profiles)
    total, right, short = found.agg(
        F.count_if(F.length("review") >= 30), F.count_if(F.col("detected_lang") == F.col("review_lang")),
        F.count_if((F.length("review") < 30) & (F.col("detected_lang") != "und")),
    ).first()
    assert right / total > 0.95 and short == 0
    empty = spark.createDataFrame([(1, None), (2, ""), (3, "too short")], "id bigint, review string")
    got = {r.id: r.detected_lang for r in languages.detect_language(empty, profiles).collect()}
    assert got == {1: None, 2: None, 3: "und"}
    open_ones = test.withColumn("review_lang", F.lit(None).cast("string"))
    assert languages.batch_detect_language(open_ones, profiles, {"en": "eng"}).filter("review_lang = 'eng'").count() > 100


def test_star_details(spark, rows):
    dates = {r.date_id: r for r in star.dim_date(spark).collect()}
    assert len(dates) == 18263 and max(dates) == d("2019-01-01")
    day = dates[d("2018-12-31")]
    assert (day.year_iso_week, day.calendar_week, day.quarter, day.weekend) == ("2019/01", 1, "Q4", "Weekday")
    assert (day.iso_start_week, day.iso_end_week) == (d("2018-12-31"), d("2019-01-06"))
    tags = spark.createDataFrame(
        [("été",), ("ab",), ("123.4",), ("12345",), ("#tag",), ("x" * 41,), ("sci-fi",)], "tag string"
    )
    assert rows(tags.filter(star.presentable_tag("tag"))) == [("sci-fi",), ("été",)]
    mds = spark.createDataFrame([("8136", "813.6", "a-->b-->c-->d"), ("8", "8", "a")], "code string, code_w_dot string, mds_text string")
    assert rows(star.dim_mds(mds), "code", "parent_code", "text") == [
        ("", None, ""), ("8", "", "a"), ("813", None, "a-->b-->c"), ("8136", "813", "a-->b-->c-->d")
    ]


def test_made_up_reviewers_follow_their_shares(spark):
    users = spark.range(20000).select(
        F.col("id"), F.lit("n").alias("username"), F.lit(1).alias("site_id")
    )
    site = spark.createDataFrame([(1, "s")], "id int, logical_name string")
    people = star.dim_reviewer(users, site)
    share = {r.gender: r["count"] / 20000 for r in people.groupBy("gender").count().collect()}
    assert share == pytest.approx({"F": 0.4, "M": 0.36, "U": 0.24}, abs=0.02)
    assert people.filter("birth_year < 1950 or birth_year > 2000").isEmpty()
    city = spark.createDataFrame(
        [("a", 0.0, 0.0, 700, 700), ("b", 1.0, 1.0, 300, 1000)], "city string, lat double, long double, pop bigint, pop_cum bigint"
    )
    placed = star.assign_city(people, city, 1000, slices=16)
    counts = {r.city: r["count"] for r in placed.groupBy("city").count().collect()}
    assert sum(counts.values()) == 20000 and counts["a"] / 20000 == pytest.approx(0.7, abs=0.02)


def test_queues_small(spark, rows):
    work = spark.createDataFrame([(1, None), (2, None), (3, None), (4, "2016-01-01")], "refid bigint, last_harvest_dts string")
    info = spark.createDataFrame([(1, 5), (2, 3)], "work_refid bigint, popularity int")
    same = spark.createDataFrame([(3, 1)], "work_refid bigint, master_refid bigint")
    assert rows(queues.works_without_info(work, info, same, 10)) == [(4,)]
    isbn = spark.createDataFrame([(1, 11, None), (1, 12, "x"), (2, 21, None)], "work_refid bigint, ean bigint, deletion_date string")
    lang = spark.createDataFrame([(11, "eng"), (12, "eng"), (21, "eng")], "ean bigint, lang_code string")
    mapping = spark.createDataFrame([(1, 2, "u", "2016-01-01"), (2, 4, "v", "2016-01-01")],
                                    "work_refid bigint, site_id int, work_uid string, last_harvest_dts string")
    args = (info, same, isbn, lang, mapping)
    assert rows(queues.works_not_harvested(*args, site_id=2, n=5)) == [(2, 3, 21)]
    assert rows(queues.works_not_harvested(*args, site_id=4, n=5)) == [(1, 5, 11)]
    assert rows(queues.mapped_on_one_site_only(mapping, same, isbn, present=4, absent=2, n=5)) == [(2, 21)]
    reviews = spark.createDataFrame([(4, 1, "eng"), (4, 1, "eng"), (4, 1, "fre")], "work_refid bigint, site_id int, review_lang string")
    stats = queues.harvest_stats(work, reviews, 1, 5)
    assert queues.lang_count_map(stats).first().nb_in_db == {"eng": 2, "fre": 1}


def test_lang_histogram_trims_codes(spark, rows):
    df = spark.createDataFrame([("eng",), ("-- ",), ("",), ("eng ",), (None,)], "review_lang string")
    assert rows(reports.lang_histogram(df)) == [("eng", 2)]


def test_handy_views(spark):
    ledger = spark.createDataFrame(
        [], "id int, batch_job string, step_name string, status string, run_dts timestamp, rows_impacted bigint")
    reviews = spark.createDataFrame([(1, 2)], "id bigint, work_refid bigint")
    reports.handy_views(reviews, reviews, ledger)
    assert spark.table("handy_review").columns == ["id", "work_refid"]
    assert spark.table("handy_load_audit").columns[0] == "id"
