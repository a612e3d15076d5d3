import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import fields, ids, text
from shelfmark.functions.isbn import isbn10_to_13


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "isbn, expected",
    [
        ("1-56619-909-3", "9781566199094"),
        ("2868890067", "9782868890061"),
        ("2123456802", "9782123456803"),
        ("817450494X", "9788174504944"),
        ("12345", None),
    ],
)
def test_isbn10_to_13(spark, isbn, expected):
    assert one(spark, isbn10_to_13(F.lit(isbn))) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [(" (1) &nbsp;", "1"), ("(14324)p;", "14324"), ("Portuguese (Portugal)", None), ("12", None)],
)
def test_digits_in_parentheses(spark, raw, expected):
    assert one(spark, fields.digits_in_parentheses(F.lit(raw))) == expected


def test_identifiers(spark):
    assert one(spark, ids.md5_uuid(F.lit("a"))) == "0cc175b9-c0f1-b6a8-31c3-99e269772661"
    assert one(spark, ids.md5_uuid(F.lit(None).cast("string"))) is None
    joined = one(spark, ids.derive_user_id(F.lit("u1"), F.lit("site")))
    assert joined == one(spark, ids.md5_uuid(F.lit("u1site")))
    skipped = one(spark, ids.derive_user_id(F.lit(None).cast("string"), F.lit("site")))
    assert skipped == one(spark, ids.md5_uuid(F.lit("site")))
    assert one(spark, ids.derive_other_work_id(F.lit("u1"), F.lit("site"))) == joined


def test_short_forms(spark):
    title = " title blank with leading/trailing  "
    assert one(spark, ids.dashed_title(F.lit(title))) == "TITLE-BLANK-WITH-LEADING/TRAILING"
    assert one(spark, ids.short_form(F.lit("  a \t b  straße "))) == "A B STRAßE"
    assert one(spark, ids.author_label(F.lit("Jane"), F.lit("Doe"))) == "DOE, JANE"
    assert one(spark, ids.author_label(F.lit(None).cast("string"), F.lit("Doe"))) == "DOE, "


def reference_trigrams(value):
    words = "".join(c if c.isalnum() else " " for c in value.lower()).split()
    return {f"  {w} "[i:i + 3] for w in words for i in range(len(w) + 1)}


def test_trigram_similarity_known_value(spark):
    v = one(spark, text.trigram_similarity(F.lit("word"), F.lit("two words")))
    assert round(v, 4) == 0.3636
    assert one(spark, text.trigram_similarity(F.lit("--"), F.lit("..."))) == 0.0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abcdefXYZ é019 .,-\n", max_size=40), min_size=1, max_size=5))
def test_trigrams_match_definition(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r["n"] for r in df.select(F.size(text.trigrams("t")).alias("n")).collect()]
    assert got == [len(reference_trigrams(v)) for v in values]


def test_trigrams_of_one_long_word_stay_linear(spark):
    word = "".join(chr(97 + (i * i) % 26) for i in range(200_000))
    n = one(spark, F.size(text.trigrams(F.lit(word))))
    assert n == len(reference_trigrams(word))


RATINGS = [
    (fields.LIBRARYTHING, "ss10.gif", 10), (fields.LIBRARYTHING, "ss7.gif", 7), (fields.LIBRARYTHING, None, None),
    (fields.AMAZON, "4.0 out of 5 stars", 8), (fields.AMAZON, "5.0 out of 5 stars", 10), (fields.AMAZON, None, None),
    (fields.GOODREADS, "4", 8), (fields.GOODREADS, "0", None), (fields.GOODREADS, None, None),
    (fields.BABELIO, "Livres 4.00/5", 8), (fields.BABELIO, "3.50", 6), (fields.BABELIO, None, 0),
    (fields.CRITIQUESLIBRES, "9 etoiles", 9), (fields.CRITIQUESLIBRES, "10 etoiles", 10),
]


def test_parsed_rating(spark):
    df = spark.createDataFrame(RATINGS, "site string, raw string, expected int")
    got = df.select("site", "raw", fields.parsed_rating("site", "raw").alias("v"), "expected").collect()
    assert [(r.site, r.raw, r.v) for r in got] == [tuple(r) for r in RATINGS]


DATES = [
    (fields.LIBRARYTHING, "Nov 22, 2012", datetime.date(2012, 11, 22)),
    (fields.LIBRARYTHING, "no date", None),
    (fields.GOODREADS, "Jul 14, 2015", datetime.date(2015, 7, 14)),
    (fields.AMAZON, "on June 21, 2003", datetime.date(2003, 6, 21)),
    (fields.BABELIO, "22 février 2016", datetime.date(2016, 2, 22)),
    (fields.BABELIO, "1 brumaire 2016", None),
    (fields.CRITIQUESLIBRES, " - BOURGES - 50 ans - 1 décembre 2004", datetime.date(2004, 12, 1)),
    (fields.CRITIQUESLIBRES, None, None),
]


def test_parsed_date(spark):
    df = spark.createDataFrame([d[:2] for d in DATES], "site string, raw string")
    got = [r.v for r in df.select(fields.parsed_date("site", "raw").alias("v")).collect()]
    assert got == [d[2] for d in DATES]


LIKES = [
    (fields.LIBRARYTHING, "1", 1, None), (fields.LIBRARYTHING, " ", None, None),
    (fields.GOODREADS, "1 like", 1, None), (fields.GOODREADS, "12 likes", 12, None),
    (fields.BABELIO, "7", 7, None), (fields.AMAZON, "14 people found this helpful", 14, None),
    (fields.AMAZON, "3 of 5 people found this helpful", 3, 2),
    (fields.AMAZON, "1,203 of 1,500 people found this helpful", 1203, 297),
    (fields.AMAZON, "One person found this helpful", None, None),
]


def test_likes_and_dislikes(spark):
    df = spark.createDataFrame([r[:2] for r in LIKES], "site string, raw string")
    got = df.select(
        fields.parsed_likes("site", "raw").alias("a"), fields.parsed_dislikes("site", "raw").alias("b")
    ).collect()
    assert [(r.a, r.b) for r in got] == [r[2:] for r in LIKES]


UIDS = [
    (fields.LIBRARYTHING, "/profile/yermat", None, "yermat", "yermat"),
    (fields.GOODREADS, "/user/show/35461072-rayfes-mondal", "Rayfes", "35461072-rayfes-mondal", "Rayfes"),
    (fields.AMAZON, "/gp/pdp/profile/A3FVDEFHGRLLYH/ref=cm_cr", "Bob", "A3FVDEFHGRLLYH", "Bob"),
    (fields.AMAZON, None, None, "A customer", "A customer"),
    (fields.BABELIO, "/monprofil.php?id_user=221169", "Eve", "221169", "Eve"),
    (fields.CRITIQUESLIBRES, "/i.php/vuser/?uid=1086c1540e35", "Fab", "1086c1540e35", "Fab"),
]


def test_user_uid(spark):
    df = spark.createDataFrame([r[:3] for r in UIDS], "site string, link string, name string")
    uid = fields.user_uid("site", "link", "name")
    got = df.select(uid.alias("u"), fields.user_name("site", uid, "name").alias("n")).collect()
    assert [(r.u, r.n) for r in got] == [r[3:] for r in UIDS]


def test_corrected_mds(spark):
    cases = [
        ("813.6", ["Literature", "American And Canadian", "Fiction", "21st Century"], None),
        ("613.04244", ["Technology", "Medicine", "Health; Hygiene", "not-set", "Essays", "More"], "613.04"),
        ("848", ["Literature", "French"], "84"),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "code string, levels array<string>")
    got = df.select(*[c.alias(n) for n, c in fields.corrected_mds("code", "levels").items()]).collect()
    assert [r.mds_code_corr for r in got] == [c[2] for c in cases]
    assert got[0].mds_text == "Literature-->American And Canadian-->Fiction-->21st Century"


def test_split_literal(spark):
    df = spark.createDataFrame([("a|b",), ("",), (None,)], "t string")
    got = [r.v for r in df.select(text.split_literal("t", "|").alias("v")).collect()]
    assert got == [["a", "b"], None, None]
