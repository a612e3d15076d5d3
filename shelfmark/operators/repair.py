"""Data-quality repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def mostly_capitals(col: Column | str, min_length: int = 30, max_rest: float = 0.5) -> Column:
    """True for texts whose capital letters A-Z make up more than half."""
    rest = F.length(F.regexp_replace(col, "[A-Z]", ""))
    return (
        (F.length(col) >= min_length)
        & F.rlike(F.col(col) if isinstance(col, str) else col, F.lit("[A-Z]"))
        & (rest / F.length(col) < max_rest)
    )


def reset_lang_for_caps(reviews: DataFrame) -> DataFrame:
    """Forget the language of reviews written mostly in capitals."""
    return reviews.withColumn(
        "review_lang", F.when(~F.coalesce(mostly_capitals("review"), F.lit(False)), F.col("review_lang"))
    )


def lang_resets(reviews: DataFrame) -> DataFrame:
    """Reviews (id) written mostly in capitals that have a language to forget."""
    return reviews.filter(F.col("review_lang").isNotNull() & mostly_capitals("review")).select("id")


def _double_loads(reviews: DataFrame, work_sameas: DataFrame, site_id: int) -> DataFrame:
    """(work, load, site): the last load of master works whose reviews came in more than one."""
    masters = work_sameas.select(F.col("master_refid").alias("work_refid")).distinct()
    return (
        reviews.filter(F.col("site_id") == site_id)
        .select("work_refid", "load_audit_id")
        .distinct()
        .join(masters, "work_refid", "left_semi")
        .groupBy("work_refid")
        .agg(F.max("load_audit_id").alias("load_audit_id"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("work_refid", "load_audit_id", F.lit(site_id).alias("site_id"))
    )


_LOAD_KEY = ["work_refid", "load_audit_id", "site_id"]


def drop_double_loaded_master(reviews: DataFrame, work_sameas: DataFrame, site_id: int = 1) -> DataFrame:
    """Drop the last load of master works whose reviews came in more than one load."""
    return reviews.join(_double_loads(reviews, work_sameas, site_id), _LOAD_KEY, "left_anti")


def double_loaded_master(reviews: DataFrame, work_sameas: DataFrame, site_id: int = 1) -> DataFrame:
    """The reviews (id) that ``drop_double_loaded_master`` drops."""
    return reviews.join(_double_loads(reviews, work_sameas, site_id), _LOAD_KEY, "left_semi").select("id")


def _later_works(mapping: DataFrame, site_id: int) -> DataFrame:
    """(work, site): works mapped later to a uid another work already had."""
    on_site = mapping.filter(F.col("site_id") == site_id)
    shared = (
        on_site.filter(F.col("work_uid") != "-1")
        .groupBy("work_uid")
        .agg(F.min("load_audit_id").alias("first_load"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("work_uid", "first_load")
    )
    return (
        on_site.select("work_refid", "work_uid", "load_audit_id")
        .join(shared, "work_uid")
        .filter(F.col("load_audit_id") > F.col("first_load"))
        .select("work_refid", F.lit(site_id).alias("site_id"))
        .distinct()
    )


def drop_shared_uid_duplicates(reviews: DataFrame, mapping: DataFrame, site_id: int = 4) -> DataFrame:
    """Drop a site's reviews of works mapped later to a uid another work already had."""
    return reviews.join(_later_works(mapping, site_id), ["work_refid", "site_id"], "left_anti")


def shared_uid_duplicates(reviews: DataFrame, mapping: DataFrame, site_id: int = 4) -> DataFrame:
    """The reviews (id) that ``drop_shared_uid_duplicates`` drops."""
    return reviews.join(_later_works(mapping, site_id), ["work_refid", "site_id"], "left_semi").select("id")


def double_harvest_check(work_sameas: DataFrame, mapping: DataFrame, site_id: int = 2) -> DataFrame:
    """Duplicate works harvested on a site although their master was as well."""
    m = mapping.filter(F.col("site_id") == site_id)
    own = m.select(
        "work_refid", F.col("work_uid").alias("uid"), F.col("last_harvest_dts").alias("harvested")
    )
    master = m.select(
        F.col("work_refid").alias("master_refid"),
        F.col("work_uid").alias("master_uid"),
        F.col("last_harvest_dts").alias("master_harvested"),
    )
    return (
        work_sameas.select("work_refid", "master_refid")
        .join(own, "work_refid")
        .join(master, "master_refid")
        .select("master_refid", "work_refid", "uid", "harvested", "master_uid", "master_harvested")
    )


def strip_mds_dots(work_info: DataFrame) -> DataFrame:
    return work_info.withColumn("mds_code", F.replace("mds_code", F.lit("."), F.lit("")))


def truncate_to_known_prefix(work_info: DataFrame, mds: DataFrame) -> DataFrame:
    """Shorten classification codes to their longest known prefix, or to nothing.

    Each distinct code is handled once, whatever the number of works carrying it.
    """
    codes = work_info.select("mds_code").filter(F.length("mds_code") > 0).distinct()
    prefix = F.transform(
        F.sequence(F.lit(1), F.length("mds_code")), lambda i: F.substring("mds_code", F.lit(1), i)
    )
    longest = (
        codes.select("mds_code", F.explode(prefix).alias("code"))
        .join(mds.select("code").distinct(), "code", "left_semi")
        .groupBy("mds_code")
        .agg(F.max_by("code", F.length("code")).alias("_known"))
    )
    return work_info.join(longest, "mds_code", "left").withColumn(
        "mds_code",
        F.when(F.col("mds_code").isNotNull(), F.coalesce("_known", F.lit(""))),
    ).select(*work_info.columns)
