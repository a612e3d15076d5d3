"""Work queues: which works or isbns to fetch next.

The limit is the queue length asked for. The first ``n`` keys are picked by a top-k
over one row per work; only then are a work's isbns joined, as rows rather than as one
array per work, so a work with very many isbns stays spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def works_without_info(work: DataFrame, work_info: DataFrame, work_sameas: DataFrame, n: int) -> DataFrame:
    """Works with neither details nor a master they duplicate."""
    known = work_info.select(F.col("work_refid").alias("refid"))
    duplicate = work_sameas.select(F.col("work_refid").alias("refid"))
    return (
        work.select("refid")
        .join(known, "refid", "left_anti")
        .join(duplicate, "refid", "left_anti")
        .orderBy("refid")
        .limit(n)
    )


def works_not_harvested(
    work_info: DataFrame,
    work_sameas: DataFrame,
    work_isbn: DataFrame,
    isbn_info: DataFrame,
    mapping: DataFrame,
    *,
    site_id: int,
    n: int,
    lang: str = "eng",
    order_by_popularity: bool = False,
) -> DataFrame:
    """Isbns of the first ``n`` works in a language that the site has not been searched for."""
    masters = work_sameas.select("work_refid", "master_refid")
    live = (
        work_isbn.filter(F.col("deletion_date").isNull())
        .select("work_refid", "ean")
        .join(isbn_info.filter(F.col("lang_code") == lang).select("ean"), "ean", "left_semi")
    )
    isbns = (
        live.join(work_info.select("work_refid", "popularity"), "work_refid")
        .join(masters, "work_refid", "left")
        .select(F.coalesce("master_refid", "work_refid").alias("work_refid"), "popularity", "ean")
    )
    searched = mapping.filter(
        (F.col("site_id") == site_id) & F.col("last_harvest_dts").isNotNull()
    ).select("work_refid").distinct()
    order = ["popularity", "work_refid"] if order_by_popularity else ["work_refid", "popularity"]
    first = (
        isbns.select("work_refid", "popularity")
        .distinct()
        .join(searched, "work_refid", "left_anti")
        .orderBy(*order)
        .limit(n)
    )
    return isbns.join(first, ["work_refid", "popularity"]).select("work_refid", "popularity", "ean")


def works_with_info_not_harvested(
    work_info: DataFrame, work: DataFrame, n: int, order_by_popularity: bool = False
) -> DataFrame:
    """Works with details that were never harvested on the reference site."""
    pending = work.filter(F.col("last_harvest_dts").isNull()).select(F.col("refid").alias("work_refid"))
    order = ["popularity", "work_refid"] if order_by_popularity else ["work_refid"]
    return (
        work_info.select("work_refid", "popularity")
        .join(pending, "work_refid", "left_semi")
        .orderBy(*order)
        .limit(n)
    )


def mapped_not_harvested(mapping: DataFrame, work: DataFrame, site_id: int, n: int) -> DataFrame:
    """Mappings on a site whose work was never harvested on the reference site."""
    pending = work.filter(F.col("last_harvest_dts").isNull()).select(F.col("refid").alias("work_refid"))
    return (
        mapping.filter(F.col("site_id") == site_id)
        .select("work_refid", "work_uid")
        .join(pending, "work_refid", "left_semi")
        .orderBy("work_refid", "work_uid")
        .limit(n)
        .select("work_refid")
    )


def mapped_on_one_site_only(
    mapping: DataFrame, work_sameas: DataFrame, work_isbn: DataFrame, *, present: int, absent: int, n: int
) -> DataFrame:
    """Isbns of the first ``n`` master works mapped on one site but not on another."""
    there = mapping.filter(F.col("site_id") == present).select("work_refid").distinct()
    other = mapping.filter(F.col("site_id") == absent).select("work_refid")
    isbns = work_isbn.select("work_refid", "ean")
    first = (
        there.join(other, "work_refid", "left_anti")
        .join(work_sameas.select("work_refid"), "work_refid", "left_anti")
        .join(isbns.select("work_refid"), "work_refid", "left_semi")
        .orderBy("work_refid")
        .limit(n)
    )
    return isbns.join(first, "work_refid").select("work_refid", "ean")


def isbns_without_lang(work_isbn: DataFrame, work_info: DataFrame, isbn_info: DataFrame, n: int) -> DataFrame:
    """Eans without a language, those of popular works first."""
    known = isbn_info.filter(F.col("lang_code").isNotNull()).select("ean")
    return (
        work_isbn.select("work_refid", "ean")
        .join(known, "ean", "left_anti")
        .join(work_info.select("work_refid", "popularity"), "work_refid")
        .orderBy("popularity", "ean", "work_refid")
        .limit(n)
        .select(F.col("ean").cast("string").alias("ean"), "popularity")
    )


def harvest_stats(work: DataFrame, reviews: DataFrame, site_id: int, n: int) -> DataFrame:
    """Review counts per language of the works harvested longest ago.

    Arrays run in language order and are bounded by the number of languages.
    """
    first = (
        work.filter(F.col("last_harvest_dts").isNotNull())
        .select(F.col("refid").alias("work_refid"), F.col("last_harvest_dts").cast("date").alias("last_harvest_date"))
        .orderBy("last_harvest_date", "work_refid")
        .limit(n)
    )
    counts = (
        reviews.filter(F.col("site_id") == site_id)
        .groupBy("work_refid", "review_lang")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    pair = F.when(F.col("cnt").isNotNull(), F.struct("review_lang", "cnt"))
    return (
        first.join(counts, "work_refid", "left")
        .groupBy("work_refid", "last_harvest_date")
        .agg(F.sort_array(F.collect_list(pair)).alias("pairs"))
        .select(
            "work_refid",
            "last_harvest_date",
            F.col("pairs.review_lang").alias("langs"),
            F.col("pairs.cnt").alias("cnts"),
        )
    )


def lang_count_map(stats: DataFrame) -> DataFrame:
    """The two arrays as one map language -> count; NULL where nothing is stored."""
    named = F.filter(
        F.arrays_zip("langs", "cnts"), lambda p: p["langs"].isNotNull()
    )
    return stats.withColumn(
        "nb_in_db", F.when(F.size("langs") > 0, F.map_from_entries(named))
    ).drop("langs", "cnts")


def period_class(date: Column | str, last_harvest: Column | str | None, until: Column | str) -> Column:
    """-1 before the last harvest, 0 from it (inclusive) to ``until`` (exclusive), 1 after.

    Without a last harvest the period starts on 1900-01-01.
    """
    date = F.col(date) if isinstance(date, str) else date
    floor = F.lit("1900-01-01").cast("date")
    start = floor if last_harvest is None else F.coalesce(last_harvest, floor)
    return F.when(date < start, -1).when(date < until, 0).when(date >= until, 1)


def within_period(df: DataFrame, date: str, last_harvest: Column | str | None, until: Column) -> DataFrame:
    """Rows whose date lies in the harvest period; undated rows are dropped."""
    return df.filter(period_class(date, last_harvest, until) == 0)
