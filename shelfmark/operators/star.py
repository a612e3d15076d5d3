"""Star schema: dimensions, bridges and the review fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.operators.keys import with_ids
from shelfmark.operators.merge import dense_ids

# The languages standing for "not found" and "not known".
NO_LANGUAGE = [("---", "Not found", "Pas trouvé"), ("unk", "Unknown", "Inconnu")]


def dim_site(site: DataFrame, site_identifier: DataFrame, ids: Sequence[int] = (1, 2, 4)) -> DataFrame:
    hosts = site_identifier.select(F.col("site_id").alias("id"), "hostname")
    return (
        site.filter(F.col("id").isin(*ids))
        .join(hosts, "id")
        .select(F.col("id").alias("site_id"), F.col("logical_name").alias("name"), "hostname")
    )


def dim_language(language: DataFrame) -> DataFrame:
    extra = language.sparkSession.createDataFrame(NO_LANGUAGE, "code string, name string, french_name string")
    known = language.select("code", F.col("english_name").alias("name"), "french_name")
    return known.union(extra).distinct()


def dim_date(
    spark: SparkSession, used: DataFrame | None = None, first: str = "1969-01-01", last: str = "2019-01-01"
) -> DataFrame:
    """One row per calendar day with its month, quarter and ISO week.

    The days from ``first`` to ``last``, further where the days ``used`` (date_id) lie outside.
    """
    d = F.col("date_id")
    iso_year = F.extract(F.lit("yearofweek"), d)
    iso_day = F.weekday(d)
    begin, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    if used is None:
        reach = spark.range(1).select(begin.alias("begin"), end.alias("end"))
    else:
        reach = used.agg(
            F.least(F.min("date_id"), begin).alias("begin"), F.greatest(F.max("date_id"), end).alias("end"))
    span = reach.select(F.explode(F.sequence("begin", "end")).alias("date_id"))
    return span.select(
        "date_id",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("calendar_week"),
        F.date_format(d, "dd.MM.yyyy").alias("format_date"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.concat(F.year(d).cast("string"), F.lit("/Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.date_format(d, "yyyy/MM").alias("year_month"),
        F.concat(iso_year.cast("string"), F.lit("/"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")).alias(
            "year_iso_week"
        ),
        F.when(iso_day >= 5, "Weekend").otherwise("Weekday").alias("weekend"),
        F.date_sub(d, iso_day).alias("iso_start_week"),
        F.date_add(d, 6 - iso_day).alias("iso_end_week"),
        F.trunc(d, "month").alias("month_start"),
        F.last_day(d).alias("month_end"),
    )


def dim_mds(mds: DataFrame) -> DataFrame:
    """Classification codes, and the parents that are not codes themselves.

    A parent's text is the path without its last level. One pass only: parents added
    here have no parent of their own.
    """
    codes = mds.select(
        "code",
        F.substring(F.col("code"), F.lit(1), F.length("code") - 1).alias("parent_code"),
        F.col("code_w_dot").alias("original_code"),
        F.col("mds_text").alias("text"),
    )
    levels = F.split("text", "-->")
    path = F.array_join(F.slice(levels, F.lit(1), F.size(levels) - 1), "-->")
    parents = (
        codes.select(F.col("parent_code").alias("code"), path.alias("text"))
        .groupBy("code")
        .agg(F.max("text").alias("text"))
        .join(codes.select("code"), "code", "left_anti")
    )
    return codes.unionByName(parents, allowMissingColumns=True)


def dim_book(work_info: DataFrame, work_title: DataFrame, work_sameas: DataFrame) -> DataFrame:
    """Titled master works with their French and German titles."""
    lang = F.rtrim("ori_lang_code")
    books = (
        work_info.filter(F.col("title").isNotNull())
        .join(work_sameas.select("work_refid"), "work_refid", "left_anti")
        .select(
            "work_refid",
            "title",
            F.when(lang.isNull(), "unk").when(lang == "--", "---").otherwise(F.lower(lang)).alias("lang_ori"),
            "mds_code",
        )
    )
    translated = (
        work_title.filter(F.col("lang_code").isin("fre", "ger"))
        .groupBy("work_refid")
        .agg(
            F.max(F.when(F.col("lang_code") == "fre", F.col("title"))).alias("french_title"),
            F.max(F.when(F.col("lang_code") == "ger", F.col("title"))).alias("german_title"),
        )
    )
    return books.join(translated, "work_refid", "left").select(
        F.col("work_refid").alias("book_id"),
        F.col("title").alias("title_ori"),
        "lang_ori",
        "mds_code",
        F.col("title").alias("english_title"),
        "french_title",
        "german_title",
    )


def presentable_tag(tag: Column | str) -> Column:
    """Tags that start with three word characters, are no number and not too long."""
    tag = F.col(tag) if isinstance(tag, str) else tag
    return (
        F.rlike(tag, F.lit(r"(?U)^\w{3,}")) & ~F.rlike(tag, F.lit(r"^[0-9.]+$")) & (F.length(tag) <= 40)
    )


def tag_forms(tag: DataFrame) -> DataFrame:
    """Presentable tags, one row per upper-case form."""
    return (
        tag.filter(presentable_tag("tag"))
        .groupBy(F.col("tag_upper").alias("tag_name"))
        .agg(F.max("lang_code").alias("lang_code"))
    )


def dim_tag(tag: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Presentable tags with a surrogate id: that of the registry, or a number in this build alone."""
    forms = tag_forms(tag)
    return dense_ids(forms, "tag_name", "tag_id") if registry is None else with_ids(forms, registry, "tag_name", "tag_id")


def rel_tag(work_tag: DataFrame, tag: DataFrame, dim_tag: DataFrame, dim_book: DataFrame) -> DataFrame:
    forms = tag.select(F.col("id").alias("tag_uuid"), F.col("tag_upper").alias("tag_name")).join(
        dim_tag.select("tag_id", "tag_name"), "tag_name"
    )
    # Pairs of books that are left out go first; repeated ones as two numbers, not with their long ids.
    return (
        work_tag.select(F.col("work_refid").alias("book_id"), F.col("tag_id").alias("tag_uuid"))
        .join(dim_book.select("book_id"), "book_id", "left_semi")
        .join(forms, "tag_uuid")
        .select("book_id", "tag_id")
        .distinct()
    )


def named_authors(author: DataFrame, author_info: DataFrame) -> DataFrame:
    names = author_info.select(F.col("author_id").alias("id"), "name")
    return author.select("id", "code").join(names, "id").select("code", "name")


def dim_author(author: DataFrame, author_info: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Named authors with a surrogate id: that of the registry, or a number in this build alone."""
    named = named_authors(author, author_info)
    return dense_ids(named, "code", "author_id") if registry is None else with_ids(named, registry, "code", "author_id")


def rel_author(work_author: DataFrame, author: DataFrame, dim_author: DataFrame, dim_book: DataFrame) -> DataFrame:
    coded = (
        author.select(F.col("id").alias("author_uuid"), "code")
        .join(dim_author.select("author_id", "code"), "code")
        .select("author_uuid", "author_id")
    )
    return (
        work_author.select(F.col("work_refid").alias("book_id"), F.col("author_id").alias("author_uuid"))
        .join(coded, "author_uuid")
        .join(dim_book.select("book_id"), "book_id", "left_semi")
        .select("book_id", "author_id")
        .distinct()
    )


def uniform(key: Column | str, salt: str) -> Column:
    """A draw in [0, 1) fixed by key and salt: the same on every run and every retry."""
    digest = F.md5(F.concat_ws("|", key, F.lit(salt)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def normal(key: Column | str, salt: str, spread: float) -> Column:
    """A normally distributed draw around zero (Box-Muller on two uniform draws)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(key, salt + "r")))
    return radius * F.cos(F.lit(2 * 3.141592653589793) * uniform(key, salt + "a")) * spread


def dim_reviewer(users: DataFrame, site: DataFrame) -> DataFrame:
    """Named users with made-up gender, status and birth year.

    Each branch draws anew, which gives F .40, M .36, U .24 and Single .40,
    Married .36, Divorced .048, other .192.
    """
    names = site.select(F.col("id").alias("site_id"), F.col("logical_name").alias("site_name"))
    key = F.col("reviewer_uuid")
    return (
        users.filter(F.col("username").isNotNull())
        .select(F.col("id").cast("string").alias("reviewer_uuid"), "username", "site_id")
        .join(names, "site_id")
        .select(
            "reviewer_uuid",
            "username",
            F.when(uniform(key, "g1") < 0.4, "F").when(uniform(key, "g2") < 0.6, "M").otherwise("U").alias("gender"),
            F.floor(uniform(key, "b") * 50 + 1950).cast("int").alias("birth_year"),
            F.when(uniform(key, "s1") < 0.4, "Single")
            .when(uniform(key, "s2") < 0.6, "Married")
            .when(uniform(key, "s3") < 0.2, "Divorced")
            .otherwise("Unknown")
            .alias("status"),
            "site_name",
        )
    )


def assign_city(reviewers: DataFrame, city: DataFrame, total_population: int, slices: int = 1024) -> DataFrame:
    """Give each reviewer a city, drawn by population, and noisy coordinates.

    ``city`` carries the running population ``pop_cum``. The range condition becomes an
    equality on equal slices of the population: a city is repeated for the slices it
    reaches (at most cities + slices rows in all), a reviewer's draw falls in one.
    """
    width = total_population / slices
    key = F.col("reviewer_uuid")
    spread = city.withColumn("_low", F.col("pop_cum") - F.col("pop")).withColumn(
        "_slice",
        F.explode(
            F.sequence(F.floor(F.col("_low") / width), F.floor(F.greatest(F.col("pop_cum") - 1, "_low") / width))
        ),
    )
    drawn = reviewers.withColumn(
        "_draw", F.floor(uniform(key, "city") * total_population)
    ).withColumn("_slice", F.floor(F.col("_draw") / width))
    return (
        drawn.join(spread, "_slice")
        .filter((F.col("_draw") >= F.col("_low")) & (F.col("_draw") < F.col("pop_cum")))
        .select(
            *reviewers.columns,
            "city",
            (F.col("lat") + normal(key, "lat", 0.3)).alias("lati"),
            (F.col("long") + normal(key, "long", 0.3)).alias("longi"),
        )
    )


def fact_review(reviews: DataFrame, dim_book: DataFrame, dim_reviewer: DataFrame, similar: DataFrame) -> DataFrame:
    """Reviews of loaded books by loaded reviewers, with the review they resemble.

    Every lookup table is unique on its key; a book with very many reviews is skewed on
    the fact side only, which the adaptive join splits. Keys are resolved without the text,
    which is joined once, by review id.
    """
    books = dim_book.select("book_id")
    people = dim_reviewer.select(F.col("reviewer_uuid").alias("user_uuid"), "reviewer_id")
    like = similar.select(F.col("review_id").alias("id"), F.col("other_review_id").alias("similarto_id"))
    return (
        reviews.drop("review").withColumnRenamed("work_refid", "book_id")
        .join(books, "book_id", "left_semi")
        .withColumn("user_uuid", F.col("user_id").cast("string"))
        .join(people, "user_uuid")
        .join(like, "id", "left")
        .join(reviews.select("id", "review"), "id")
        .select(
            "id", "similarto_id", "book_id", "reviewer_id", "site_id",
            F.col("review_date").alias("date_id"),
            F.col("parsed_rating").alias("rating"),
            F.col("parsed_likes").alias("nb_likes"),
            F.col("review_lang").alias("lang_code"),
            "review",
        )
    )
