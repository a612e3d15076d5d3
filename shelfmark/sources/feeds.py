"""The isbn feed, the listing service and what file names tell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.functions.isbn import isbn10_to_13

ISBN_FEED = "_workcode bigint, isbn array<struct<_VALUE: string, _uncertain: string>>"
LISTING = (
    "struct<total: string, success: int, message: string, data: array<struct<id: string, titre: string, "
    "nbrcrit: string, cover: string, cote: string, hits: string, auteurstring: string>>>"
)


def read_isbn_feed(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """(work, isbn as given, isbn10, isbn13) rows of the XML feed.

    Isbns marked uncertain are dropped, as are those of neither 10 nor 13 characters.
    """
    works = spark.read.format("xml").option("rowTag", "work").schema(ISBN_FEED).load(path)
    isbn = F.col("i._VALUE")
    rows = (
        works.select(F.col("_workcode").alias("work_refid"), F.explode("isbn").alias("i"))
        .filter(F.col("i._uncertain").isNull() & F.length(isbn).isin(10, 13))
        .select(
            "work_refid",
            isbn.alias("isbn_ori"),
            F.when(F.length(isbn) == 10, isbn).otherwise("").alias("isbn10"),
            F.when(F.length(isbn) == 10, isbn10_to_13(isbn)).otherwise(isbn).alias("isbn13"),
        )
    )
    return rows if max_rows is None else rows.limit(max_rows)


def parse_listing(payloads: DataFrame, column: str = "value") -> DataFrame:
    """Books of listing replies that have more than one further review.

    A reply is JSON in parentheses. A reply that reports a failure fails the job. The
    author text ``Last, First`` is split at the first comma.
    """
    bare = F.regexp_replace(F.trim(F.regexp_replace(column, r"^\s+|\s+$", "")), r"^\(|\)$", "")
    reply = payloads.select(F.from_json(bare, LISTING).alias("r"))
    checked = reply.select(
        F.when(F.col("r.success") == 0, F.col("r.data"))
        .otherwise(F.raise_error(F.concat(F.lit("listing failed: "), F.coalesce(F.col("r.message"), F.lit("unreadable")))))
        .alias("data")
    )
    author = F.split("auteurstring", ", ", 2)
    return (
        checked.select(F.inline("data"))
        .filter(F.col("nbrcrit").cast("int") - 1 > 1)
        .select(
            F.col("id").alias("book_uid"),
            F.col("titre").alias("title"),
            (F.col("nbrcrit").cast("int") - 1).alias("nb_reviews"),
            F.get(author, F.lit(1)).alias("author_fname"),
            F.get(author, F.lit(0)).alias("author_lname"),
        )
    )


def read_listing_json(spark: SparkSession, path: str) -> DataFrame:
    """Listing replies, one per file."""
    return parse_listing(spark.read.text(path, wholetext=True))


def period_of(file_name: Column | str) -> Column:
    """(begin, end) dates in a file name ``..._d-m-yyyy_d-m-yyyy.ext``; begin is optional."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    pattern = r"_(?:(\d{1,2}-\d{1,2}-\d{4})_)?(\d{1,2}-\d{1,2}-\d{4})\.[^.]*$"

    def date(group: int) -> Column:
        text = F.nullif(F.regexp_extract(name, pattern, group), F.lit(""))
        return F.try_to_timestamp(text, F.lit("d-M-yyyy")).cast("date")

    return F.struct(date(1).alias("begin"), date(2).alias("end"))


def with_period(df: DataFrame) -> DataFrame:
    """Add the period of the file each row was read from."""
    return df.withColumn("period", period_of(F.col("_metadata.file_name")))
