"""Normalisation jobs over staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import fields, text


def normalize_reviews(raw: DataFrame) -> DataFrame:
    """Raw review fields to the staging columns.

    Input: ``site_logical_name, rating, review_date, likes, user_link, username, review``
    and optionally ``tags`` and ``tag_counts`` (arrays of raw texts).
    """
    site = F.col("site_logical_name")
    uid = fields.user_uid(site, "user_link", "username")
    out = raw.withColumns(
        {
            "parsed_rating": fields.parsed_rating(site, "rating"),
            "parsed_review_date": fields.parsed_date(site, "review_date"),
            "parsed_likes": fields.parsed_likes(site, "likes"),
            "parsed_dislikes": fields.parsed_dislikes(site, "likes"),
            "user_uid": uid,
            "username": fields.user_name(site, uid, "username"),
            "review": clean_review(site, "review"),
        }
    ).drop("user_link")
    return pack_tags(out) if "tags" in raw.columns else out


def clean_review(site: Column | str, review: Column | str) -> Column:
    """Review text with unix line ends and without left-overs of the rating image."""
    site = F.col(site) if isinstance(site, str) else site
    unix = text.unix_lines(F.trim(review))
    return F.when(site == fields.LIBRARYTHING, text.without_empty_rating(unix)).otherwise(unix)


def pack_tags(df: DataFrame, tags: str = "tags", counts: str = "tag_counts") -> DataFrame:
    """Tag arrays to the packed list columns of the dump files; empty lists give NULL."""
    site = F.col("site_logical_name")
    some = F.size(tags) > 0
    numbers = F.transform(F.col(counts), lambda c: F.coalesce(fields.tag_count(site, c), F.lit("")))
    return df.withColumns(
        {
            "tags_t": F.when(some, F.array_join(tags, text.TAG_SEPARATOR)),
            "tags_n": F.when(some, F.array_join(numbers, text.COUNT_SEPARATOR)),
            "tags_lang": F.when(some, fields.tag_language(site)),
        }
    ).drop(tags, counts)


def marc_lookup(df: DataFrame, column: str, language: DataFrame, out: str = "marc_code", capital: bool = True) -> DataFrame:
    """Language code of a two- or three-letter code or an English or French name.

    Unknown input gives ``--``, NULL stays NULL. The lowest code counts where a name has
    several.
    """
    code = F.upper("code").alias("_code")
    names = None
    for source in ("code2", "code3", "english_name", "french_name"):
        part = language.select(F.upper(source).alias("_name"), code)
        names = part if names is None else names.union(part)
    keys = names.filter(F.col("_name").isNotNull()).groupBy("_name").agg(F.min("_code").alias("_code"))
    found = df.join(keys, F.upper(F.trim(column)) == F.col("_name"), "left")
    value = F.when(F.col(column).isNotNull(), F.coalesce("_code", F.lit("--")))
    return found.withColumn(out, value if capital else F.lower(value)).drop("_name", "_code")


def dedupe_editions(searched: DataFrame, results: DataFrame) -> DataFrame:
    """Editions to read per work: one for each (number of reviews, average stars).

    ``searched`` names the works looked for, ``results`` holds ``work_refid, position,
    asin, stars, nb_reviews`` as raw text. Of equal pairs the first in page order is
    kept. A work without any result gives ``-1``, one without reviewed results ``-2``.
    """
    stars = fields.found(F.col("stars"), r"^(.*?) ?out of 5 stars")
    reviewed = results.filter(stars.isNotNull()).select(
        "work_refid", "position", "asin",
        stars.alias("avg_stars"),
        text.count_of("nb_reviews").alias("nb"),
    )
    kept = (
        reviewed.groupBy("work_refid", "nb", "avg_stars")
        .agg(F.min_by("asin", "position").alias("work_uid"))
        .select("work_refid", "work_uid")
    )
    any_result = results.select("work_refid").distinct().withColumn("_found", F.lit(True))
    without = (
        searched.select("work_refid").distinct()
        .join(kept, "work_refid", "left_anti")
        .join(any_result, "work_refid", "left")
        .select("work_refid", F.when(F.col("_found"), "-2").otherwise("-1").alias("work_uid"))
    )
    return kept.union(without)


def isbn_lang(reply: Column | str) -> Column:
    """Language reply for an isbn: three letters, ``unknown`` means undetermined, else NULL."""
    reply = F.col(reply) if isinstance(reply, str) else reply
    return F.when(F.length(reply) == 3, reply).when(reply == "unknown", "und")


def validate_isbn_lang(replies: DataFrame, column: str = "reply") -> tuple[DataFrame, DataFrame]:
    """(accepted with ``lang_code``, rejected) replies."""
    coded = replies.withColumn("lang_code", isbn_lang(column))
    return (
        coded.filter(F.col("lang_code").isNotNull()).drop(column),
        coded.filter(F.col("lang_code").isNull()).drop("lang_code"),
    )
