import datetime

from pyspark.sql import functions as F

from shelfmark.functions import ids
from shelfmark.operators import loads, merge

NOW, LATER = "2016-05-01 10:00:00", "2016-06-01 10:00:00"
WORK = "refid bigint, last_harvest_dts timestamp_ntz, last_seen_date date, create_dts timestamp_ntz, load_audit_id int"
SITES = [(1, "librarything"), (2, "goodreads")]


def day(text):
    return datetime.date.fromisoformat(text[:10])


def test_merge_work_twice_changes_only_the_seen_date(spark, rows):
    feed = spark.createDataFrame([(1,), (1,), (2,)], "work_refid bigint")
    first = loads.merge_work(spark.createDataFrame([], WORK), feed, NOW, 7)
    second = loads.merge_work(first, feed.filter("work_refid = 2"), LATER, 8)
    assert rows(second, "refid", "last_seen_date", "load_audit_id") == [(1, day(NOW), 7), (2, day(LATER), 7)]


def test_merge_isbn_takes_one_row_per_ean(spark, rows):
    schema = "ean bigint, isbn13 string, isbn10 string, last_seen_date date, create_dts timestamp_ntz, load_audit_id int"
    feed = spark.createDataFrame(
        [("9780000000001", ""), ("9780000000001", "123456789X"), ("bad", "x")], "isbn13 string, isbn10 string"
    )
    out = loads.merge_isbn(spark.createDataFrame([], schema), feed, NOW, 1)
    assert rows(out, "ean", "isbn10") == [(9780000000001, "123456789X")]


def test_sync_work_isbn_deletes_revives_and_ignores_ambiguous(spark, rows):
    schema = (
        "work_refid bigint, ean bigint, last_seen_date date, deletion_date date, "
        "create_dts timestamp_ntz, load_audit_id int"
    )
    feed1 = spark.createDataFrame(
        [(1, "11"), (1, "12"), (2, "13"), (3, "13"), (4, "14"), (4, "14")], "work_refid bigint, isbn13 string"
    )
    t1 = loads.sync_work_isbn(spark.createDataFrame([], schema), feed1, NOW, 1)
    assert rows(t1, "work_refid", "ean") == [(1, 11), (1, 12)]
    feed2 = spark.createDataFrame([(2, "12")], "work_refid bigint, isbn13 string")
    t2 = loads.sync_work_isbn(t1, feed2, LATER, 2)
    assert rows(t2, "work_refid", "ean", "deletion_date") == [
        (1, 11, day(LATER)), (1, 12, day(LATER)), (2, 12, None)
    ]
    t3 = loads.sync_work_isbn(t2, feed1.filter("isbn13 = '11'"), "2016-07-01 00:00:00", 3)
    assert rows(t3, "work_refid", "ean", "deletion_date") == [
        (1, 11, None), (1, 12, day("2016-07-01")), (2, 12, day("2016-07-01"))
    ]


def work_stage(spark):
    return spark.createDataFrame(
        [
            (1, None, "T1", "A B;C D;X", "ab;cd", "813.6", None, "L-->F", "97,109",
             "French : Rien__&__German : So: ja__&__Klingon : q__&__ : none"),
            (2, 9, "T2", "A Z", "ab", "12.3", "12", None, None, None),
            (3, None, "T3", "", "", None, None, None, "x", None),
        ],
        "work_refid bigint, dup_refid bigint, title string, authors string, authors_code string, "
        "mds_code string, mds_code_corr string, mds_text string, popularity string, other_lang_title string",
    ).withColumns({"original_lang": F.lit("English"), "ori_lang_code": F.lit("eng"), "lc_subjects": F.lit("s")})


def test_work_details(spark, rows):
    stage = work_stage(spark)
    none = spark.createDataFrame([], "work_refid bigint")
    info = loads.insert_work_info(none, stage, NOW, 1)
    assert rows(info, "work_refid", "mds_code", "mds_code_ori", "popularity") == [
        (1, "8136", "813.6", 97109), (2, "12", "12.3", None), (3, None, None, None)
    ]
    again = loads.insert_work_info(info.select("work_refid"), stage, NOW, 2)
    assert again.count() == 0
    authors = loads.insert_author(spark.createDataFrame([("cd",)], "code string"), stage, NOW, 1)
    assert rows(authors, "code") == [("ab",)]
    names = loads.insert_author_info(spark.createDataFrame([], "author_id string"), stage, NOW, 1)
    assert rows(names, "name") == [("A Z",), ("C D",)]
    links = loads.insert_work_author(spark.createDataFrame([], "author_id string, work_refid bigint"), stage, NOW, 1)
    assert rows(links, "work_refid") == [(1,), (1,), (2,)]
    same = loads.insert_work_sameas(spark.createDataFrame([], "work_refid bigint, master_refid bigint"), stage, NOW, 1)
    assert rows(same, "work_refid", "master_refid") == [(9, 2)]
    codes = loads.insert_mds(spark.createDataFrame([("12",)], "code string"), stage, NOW, 1)
    assert rows(codes, "code", "code_w_dot", "mds_text") == [("8136", "813.6", "L-->F")]
    language = spark.createDataFrame([("fre", "French"), ("ger", "German")], "code string, english_name string")
    titles = loads.insert_work_title(
        spark.createDataFrame([], "work_refid bigint, lang_text string"), stage, language, NOW, 1
    )
    assert rows(titles, "lang_code", "lang_text", "title") == [
        ("fre", "French", "Rien"), ("ger", "German", "So ja"), (None, "Klingon", "q")
    ]


def review_stage(spark):
    return spark.createDataFrame(
        [
            ("goodreads", "u1", "Ann", 1, "w1", "10.0", "2", "a__&__b", "1,200 ;3", "T", "X"),
            ("goodreads", "u1", "Ann B", 1, "w1", "8", None, "a__&__b", "1,200 ;3", "T", "X"),
            ("goodreads", None, None, 2, "-1", None, None, None, None, None, None),
            ("librarything", "u1", "Ann", 3, None, "7", "x", "c", "5", None, None),
        ],
        "site_logical_name string, user_uid string, username string, work_refid bigint, work_uid string, "
        "parsed_rating string, parsed_likes string, tags_t string, tags_n string, title string, authors string",
    ).withColumns({
        "rating": F.lit("r"), "likes": F.lit("l"), "review": F.lit("text"), "tags_lang": F.lit("eng"),
        "parsed_review_date": F.lit("2016-01-01").cast("date"), "review_lang": F.lit("eng"),
        "dup_refid": F.lit(None).cast("bigint"),
    })


def test_review_loads(spark, rows):
    stage = review_stage(spark)
    sites = spark.createDataFrame(SITES, "id int, logical_name string")
    user_schema = (
        "id string, user_uid string, site_id int, username string, last_seen_date date, "
        "create_dts timestamp_ntz, load_audit_id int"
    )
    users = loads.merge_user(spark.createDataFrame([], user_schema), stage, sites, NOW, 1, "goodreads")
    assert rows(users, "user_uid", "site_id", "username") == [("u1", 2, "Ann B")]
    renamed = stage.withColumn("username", F.lit("New name"))
    again = loads.merge_user(users, renamed, sites, LATER, 2, "goodreads")
    assert rows(again, "username", "last_seen_date") == [("Ann B", day(LATER))]
    reviews = loads.append_review(stage, sites, NOW, 1)
    assert rows(reviews, "work_refid", "site_id", "parsed_rating", "parsed_likes") == [
        (1, 2, 10, 2), (1, 2, 8, None), (3, 1, 7, None)
    ]
    numbered = merge.add_ids(reviews, 100)
    assert numbered.select("id").distinct().count() == 3 and numbered.filter("id <= 100").count() == 0
    tags = loads.insert_tag(spark.createDataFrame([], "id string"), stage, sites, NOW, 1, "goodreads")
    assert rows(tags, "tag", "tag_upper", "ori_site_id") == [("a", "A", 2), ("b", "B", 2)]
    schema = (
        "work_refid bigint, tag_id string, source_site_id int, frequency int, update_dts timestamp_ntz, "
        "create_dts timestamp_ntz, load_audit_id int"
    )
    links = loads.merge_work_tag(spark.createDataFrame([], schema), stage, sites, NOW, 1, "goodreads")
    assert sorted(r.frequency for r in links.collect()) == [3, 1200]
    more = stage.withColumn("tags_n", F.lit("7;9"))
    assert sorted(r.frequency for r in loads.merge_work_tag(links, more, sites, LATER, 2, "goodreads").collect()) == [7, 9]
    map_schema = (
        "work_refid bigint, work_uid string, site_id int, last_harvest_dts date, title string, authors string, "
        "create_dts timestamp_ntz, load_audit_id int"
    )
    mapped = loads.merge_site_mapping(spark.createDataFrame([], map_schema), stage, sites, NOW, 1, "goodreads")
    assert rows(mapped, "work_refid", "work_uid") == [(1, "w1"), (2, "-1")]


def test_touch_last_harvest_reaches_the_master(spark, rows):
    work = spark.createDataFrame([(1,), (2,), (3,)], "refid bigint").withColumn(
        "last_harvest_dts", F.lit(None).cast("timestamp_ntz")
    )
    same = spark.createDataFrame([(1, 2)], "work_refid bigint, master_refid bigint")
    out = loads.touch_last_harvest(work, same, spark.createDataFrame([(1,)], "work_refid bigint"), NOW)
    assert sorted(r.refid for r in out.filter("last_harvest_dts is not null").collect()) == [1, 2]


def test_delete_batch(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, load_audit_id int")
    assert rows(loads.delete_batch(df, 5), "id") == [(2,), (3,)]


def test_dense_ids_are_consecutive_in_key_order(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("k"))
    got = merge.dense_ids(df.repartition(7), "k", "n").orderBy("k").collect()
    assert [r.n for r in got] == list(range(1, 1001))


def test_merges_do_not_cross_join(spark):
    feed = spark.createDataFrame([(1,)], "work_refid bigint")
    plan = loads.merge_work(spark.createDataFrame([], WORK), feed, NOW, 7)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    anti = loads.insert_missing_work(spark.createDataFrame([], WORK), feed, NOW, 7)
    assert "LeftAnti" in anti._jdf.queryExecution().toString()


def test_user_ids_match_across_loads(spark):
    stage = review_stage(spark)
    sites = spark.createDataFrame(SITES, "id int, logical_name string")
    reviews = loads.append_review(stage, sites, NOW, 1, "goodreads").select("user_id").distinct().collect()
    expected = spark.range(1).select(ids.derive_user_id(F.lit("u1"), F.lit("goodreads"))).first()[0]
    assert [r.user_id for r in reviews] == [expected]


def test_rel_tag_reduces_pairs_once_as_numbers(spark, rows):
    """Repeated pairs are reduced after the ids are short, of books that stay only."""
    from shelfmark.operators import star

    pairs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (3, "b"), (None, "a")], "work_refid bigint, tag_id string")
    tag = spark.createDataFrame([("a", "TAG"), ("b", "TAG"), ("c", "NONE")], "id string, tag_upper string")
    dim = spark.createDataFrame([(7, "TAG")], "tag_id bigint, tag_name string")
    book = spark.createDataFrame([(1,), (3,), (3,)], "book_id bigint")
    got = star.rel_tag(pairs, tag, dim, book)
    assert rows(got) == [(1, 7), (3, 7)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
