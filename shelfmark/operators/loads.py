"""Loads from staging into the integration tables.

``now`` and ``batch_id`` are parameters, so a load repeated with the same arguments
gives the same rows. Loads that only insert return the rows to append; loads that also
touch stored rows exist twice: over a whole stored table, returning its next state, and as
the touches of a load, which a table kept as a log merges when it is read.

Packed lists are unpacked with the outer form of explode and NULLs dropped after it; the
inner form makes the optimizer split every list again for a not-empty test.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import ids, text
from shelfmark.operators.merge import missing_rows, one_per_key, stamped, upsert
from shelfmark.plans.tables import TOUCHED, layout
from shelfmark.sources.touches import touches


def _date(now: str) -> Column:
    return F.lit(now).cast("date")


def _time(now: str) -> Column:
    return F.lit(now).cast("timestamp_ntz")


def _new(now: str, batch_id: int) -> dict[str, Column]:
    return {"create_dts": _time(now), "load_audit_id": F.lit(batch_id)}


def _touches(
    table: str, staged: DataFrame, now: str, batch_id: int, creates: Mapping[str, Column] | None,
    **sets: Mapping[str, Column],
) -> DataFrame:
    return touches(TOUCHED[table], layout(table), staged, now, batch_id, creates, sets)


def of_site(stage: DataFrame, site: str | None) -> DataFrame:
    """Staged rows of one site, or of all sites."""
    return stage if site is None else stage.filter(F.col("site_logical_name") == site)


# -- reference feed: works and isbns ------------------------------------------------


def _works(stage: DataFrame) -> DataFrame:
    return stage.select(F.col("work_refid").alias("refid")).distinct()


def merge_work(work: DataFrame, feed: DataFrame, now: str, batch_id: int) -> DataFrame:
    """Works seen in the feed: known ones get a new last-seen date, others are added."""
    return upsert(
        work, _works(feed), ["refid"],
        on_match={"last_seen_date": _date(now)},
        on_insert={"last_seen_date": _date(now), **_new(now, batch_id)},
    )


def work_touches(feed: DataFrame, now: str, batch_id: int) -> DataFrame:
    """``merge_work`` as touches."""
    return _touches("work", _works(feed), now, batch_id, {"last_seen_date": _date(now)}, seen={"last_seen_date": _date(now)})


def _isbns(feed: DataFrame) -> DataFrame:
    return (
        feed.groupBy(F.col("isbn13").try_cast("long").alias("ean"))
        .agg(F.max("isbn13").alias("isbn13"), F.max("isbn10").alias("isbn10"))
        .filter(F.col("ean").isNotNull())
    )


def merge_isbn(isbn: DataFrame, feed: DataFrame, now: str, batch_id: int) -> DataFrame:
    """Isbns of the feed, one row per ean (the highest spelling and isbn10 where several exist)."""
    return upsert(
        isbn, _isbns(feed), ["ean"],
        on_match={"last_seen_date": _date(now)},
        on_insert={
            "isbn13": F.col("s.isbn13"), "isbn10": F.col("s.isbn10"),
            "last_seen_date": _date(now), **_new(now, batch_id),
        },
    )


def isbn_touches(feed: DataFrame, now: str, batch_id: int) -> DataFrame:
    """``merge_isbn`` as touches."""
    new = {"isbn13": F.col("isbn13"), "isbn10": F.col("isbn10"), "last_seen_date": _date(now)}
    return _touches("isbn", _isbns(feed), now, batch_id, new, seen={"last_seen_date": _date(now)})


def unambiguous_isbns(feed: DataFrame) -> DataFrame:
    """(work, ean) of isbns that occur on exactly one row of the feed, however they are spelled."""
    return (
        feed.groupBy(F.col("isbn13").try_cast("long").alias("ean"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("work_refid").alias("work_refid"))
        .filter((F.col("n") == 1) & F.col("ean").isNotNull())
        .select("work_refid", "ean")
    )


def sync_work_isbn(work_isbn: DataFrame, feed: DataFrame, now: str, batch_id: int) -> DataFrame:
    """Bring the (work, ean) pairs in line with a full feed.

    Pairs in the feed are seen again and revived, pairs no longer in it get a deletion
    date, new pairs are added.
    """
    seen = upsert(
        work_isbn.withColumn("_here", F.lit(False)),
        unambiguous_isbns(feed),
        ["work_refid", "ean"],
        on_match={"last_seen_date": _date(now), "deletion_date": F.lit(None), "_here": F.lit(True)},
        on_insert={"last_seen_date": _date(now), "_here": F.lit(True), **_new(now, batch_id)},
    )
    return seen.withColumn(
        "deletion_date", F.when(~F.col("_here"), _date(now)).otherwise(F.col("deletion_date"))
    ).drop("_here")


def _isbn_langs(stage: DataFrame) -> DataFrame:
    return stage.groupBy(F.col("ean").try_cast("long").alias("ean")).agg(
        F.max("lang_code").alias("lang_code")
    )


def merge_isbn_lang(isbn_info: DataFrame, stage: DataFrame, now: str, batch_id: int) -> DataFrame:
    """Language of eans; the highest code wins when the feed disagrees with itself."""
    return upsert(
        isbn_info, _isbn_langs(stage), ["ean"],
        on_match={"lang_code": F.col("s.lang_code"), "update_dts": _time(now)},
        on_insert={"lang_code": F.col("s.lang_code"), **_new(now, batch_id)},
    )


def isbn_lang_touches(stage: DataFrame, now: str, batch_id: int) -> DataFrame:
    """``merge_isbn_lang`` as touches."""
    code = {"lang_code": F.col("lang_code")}
    return _touches("isbn_info", _isbn_langs(stage), now, batch_id, code, told={**code, "update_dts": _time(now)})


# -- work details ----------------------------------------------------------------------


def insert_missing_work(work: DataFrame, stage: DataFrame, now: str, batch_id: int, site: str | None = None) -> DataFrame:
    """Works named by staged rows but not known yet."""
    if "site_logical_name" in stage.columns:
        stage = of_site(stage, site)
    new = missing_rows(work, stage.select(F.col("work_refid").alias("refid")).distinct(), ["refid"])
    return stamped(new, now, batch_id, "last_seen_date")


def missing_work_touches(stage: DataFrame, now: str, batch_id: int, site: str | None = None) -> DataFrame:
    """``insert_missing_work`` as touches: works that are new are created, known ones stay."""
    if "site_logical_name" in stage.columns:
        stage = of_site(stage, site)
    return _touches("work", _works(stage), now, batch_id, {"last_seen_date": _date(now)})


def insert_work_info(work_info: DataFrame, stage: DataFrame, now: str, batch_id: int) -> DataFrame:
    """Details of works; the corrected classification code is preferred, without dots."""
    code = F.replace(F.coalesce("mds_code_corr", "mds_code"), F.lit("."), F.lit(""))
    staged = stage.select(
        "work_refid", "title", "original_lang", "ori_lang_code",
        code.alias("mds_code"), F.col("mds_code").alias("mds_code_ori"),
        "lc_subjects", text.count_of("popularity").alias("popularity"),
    )
    return stamped(missing_rows(work_info, one_per_key(staged, ["work_refid"]), ["work_refid"]), now, batch_id)


def _author_codes(stage: DataFrame) -> DataFrame:
    """(work, code, name) rows; surplus names have no code and are dropped."""
    pairs = F.arrays_zip(
        text.split_literal("authors_code", text.AUTHOR_SEPARATOR).alias("code"),
        text.split_literal("authors", text.AUTHOR_SEPARATOR).alias("name"),
    )
    return (
        stage.select("work_refid", F.explode_outer(pairs).alias("p"))
        .select("work_refid", F.col("p.code").alias("code"), F.col("p.name").alias("name"))
        .filter(F.col("code").isNotNull())
    )


def insert_author(author: DataFrame, stage: DataFrame, now: str, batch_id: int) -> DataFrame:
    codes = (
        stage.select(F.explode_outer(text.split_literal("authors_code", text.AUTHOR_SEPARATOR)).alias("code"))
        .filter(F.col("code").isNotNull())
        .distinct()
    )
    new = missing_rows(author, codes, ["code"])
    return stamped(new.select(ids.md5_uuid("code").alias("id"), "code"), now, batch_id)


def insert_author_info(author_info: DataFrame, stage: DataFrame, now: str, batch_id: int) -> DataFrame:
    """Author names, the highest where one code has several."""
    names = _author_codes(stage).groupBy("code").agg(F.max("name").alias("name"))
    staged = names.select(ids.md5_uuid("code").alias("author_id"), "name")
    return stamped(missing_rows(author_info, staged, ["author_id"]), now, batch_id)


def insert_work_author(work_author: DataFrame, stage: DataFrame, now: str, batch_id: int) -> DataFrame:
    staged = (
        stage.select(
            "work_refid", F.explode_outer(text.split_literal("authors_code", text.AUTHOR_SEPARATOR)).alias("code")
        )
        .filter(F.col("code").isNotNull())
        .distinct()
        .select(ids.md5_uuid("code").alias("author_id"), "work_refid")
    )
    return stamped(missing_rows(work_author, staged, ["author_id", "work_refid"]), now, batch_id)


def insert_work_sameas(
    work_sameas: DataFrame, stage: DataFrame, now: str, batch_id: int, site: str | None = None
) -> DataFrame:
    """(duplicate, master) pairs found while reading; from reviews for one site only."""
    if "site_logical_name" in stage.columns:
        stage = of_site(stage, site)
    staged = (
        stage.filter(F.col("dup_refid").isNotNull())
        .select(F.col("dup_refid").alias("work_refid"), F.col("work_refid").alias("master_refid"))
        .distinct()
    )
    return stamped(missing_rows(work_sameas, staged, ["work_refid", "master_refid"]), now, batch_id)


def insert_mds(mds: DataFrame, stage: DataFrame, now: str, batch_id: int) -> DataFrame:
    """Classification codes not known yet, each once, with its highest dotted form and text."""
    dotted = F.coalesce("mds_code_corr", "mds_code")
    staged = (
        stage.select(dotted.alias("code_w_dot"), "mds_text")
        .filter(F.col("code_w_dot").isNotNull())
        .groupBy(F.replace("code_w_dot", F.lit("."), F.lit("")).alias("code"))
        .agg(F.max("code_w_dot").alias("code_w_dot"), F.max("mds_text").alias("mds_text"))
    )
    return stamped(missing_rows(mds, staged, ["code"]), now, batch_id)


def insert_work_title(
    work_title: DataFrame, stage: DataFrame, language: DataFrame, now: str, batch_id: int
) -> DataFrame:
    """Titles in other languages out of the packed ``language : title`` list.

    The title is the second to fifth element between colons, joined without them.
    """
    entry = F.explode_outer(text.split_literal("other_lang_title", text.TAG_SEPARATOR))
    parts = F.split(F.col("entry"), ":")
    titles = (
        stage.select("work_refid", entry.alias("entry"))
        .select(
            "work_refid",
            F.trim(F.get(parts, F.lit(0))).alias("lang_text"),
            F.trim(F.array_join(F.slice(parts, 2, 4), "")).alias("title"),
        )
        .filter(F.length("lang_text") > 1)
    )
    codes = language.select(F.col("code").alias("lang_code"), text.upper("english_name").alias("_name"))
    key = ["work_refid", "lang_text"]
    new = missing_rows(work_title, one_per_key(titles, key), key)
    found = new.join(codes, text.upper("lang_text") == F.col("_name"), "left").drop("_name")
    return stamped(found.select("work_refid", "lang_code", "lang_text", "title"), now, batch_id)


# -- reviews -----------------------------------------------------------------------------


def _users(stage: DataFrame, sites: DataFrame, site: str | None) -> DataFrame:
    return (
        of_site(stage, site)
        .filter(F.col("user_uid").isNotNull())
        .groupBy("site_logical_name", "user_uid")
        .agg(F.max("username").alias("username"))
        .join(sites.select(F.col("id").alias("site_id"), F.col("logical_name").alias("site_logical_name")),
              "site_logical_name")
        .select(
            ids.derive_user_id("user_uid", "site_logical_name").alias("id"),
            "user_uid", "site_id", "username",
        )
    )


def merge_user(
    users: DataFrame, stage: DataFrame, sites: DataFrame, now: str, batch_id: int, site: str | None = None
) -> DataFrame:
    """Users of staged reviews; a known user is only seen again, the name is kept."""
    return upsert(
        users, _users(stage, sites, site), ["id"],
        on_match={"last_seen_date": _date(now)},
        on_insert={
            "user_uid": F.col("s.user_uid"), "site_id": F.col("s.site_id"),
            "username": F.col("s.username"), "last_seen_date": _date(now), **_new(now, batch_id),
        },
    )


def user_touches(stage: DataFrame, sites: DataFrame, now: str, batch_id: int, site: str | None = None) -> DataFrame:
    """``merge_user`` as touches."""
    new = {c: F.col(c) for c in ("user_uid", "site_id", "username")} | {"last_seen_date": _date(now)}
    return _touches("user", _users(stage, sites, site), now, batch_id, new, seen={"last_seen_date": _date(now)})


def append_review(
    stage: DataFrame, sites: DataFrame, now: str, batch_id: int, site: str | None = None
) -> DataFrame:
    """Staged reviews with a user as integration rows, to append as one batch."""
    names = sites.select(F.col("id").alias("site_id"), F.col("logical_name").alias("site_logical_name"))
    rows = (
        of_site(stage, site)
        .filter(F.col("user_uid").isNotNull())
        .join(names, "site_logical_name")
        .select(
            "work_refid",
            ids.derive_user_id("user_uid", "site_logical_name").alias("user_id"),
            "site_id",
            "rating",
            F.col("parsed_rating").try_cast("double").cast("int").alias("parsed_rating"),
            "likes",
            F.col("parsed_likes").try_cast("int").alias("parsed_likes"),
            "review",
            F.col("parsed_review_date").alias("review_date"),
            "review_lang",
        )
    )
    return stamped(rows, now, batch_id)


def insert_tag(
    tag: DataFrame, stage: DataFrame, sites: DataFrame, now: str, batch_id: int, site: str | None = None
) -> DataFrame:
    """Tags not known yet with the site they were first seen on.

    Over several sites the lowest site id counts as the first.
    """
    names = sites.select(F.col("id").alias("site_id"), F.col("logical_name").alias("site_logical_name"))
    lists = (
        of_site(stage, site)
        .filter(F.col("tags_t").isNotNull())
        .groupBy("site_logical_name", "tags_t")
        .agg(F.max("tags_lang").alias("tags_lang"))
        .join(names, "site_logical_name")
    )
    staged = (
        lists.select("site_id", "tags_lang", F.explode_outer(text.split_literal("tags_t", text.TAG_SEPARATOR)).alias("tag"))
        .filter(F.col("tag").isNotNull())
        .groupBy("tag")
        .agg(F.max("tags_lang").alias("lang_code"), F.min("site_id").alias("ori_site_id"))
        .select(ids.md5_uuid("tag").alias("id"), "tag", text.upper("tag").alias("tag_upper"), "ori_site_id", "lang_code")
    )
    return stamped(missing_rows(tag, staged, ["id"]), now, batch_id)


def _work_tags(stage: DataFrame, sites: DataFrame, site: str | None) -> DataFrame:
    """work_refid, tag_id, source_site_id and n of the packed lists.

    Equal packed lists of a work are collapsed before they are unpacked: a work's tags
    come with each of its reviews.
    """
    names = sites.select(F.col("id").alias("source_site_id"), F.col("logical_name").alias("site_logical_name"))
    pairs = F.arrays_zip(
        text.split_literal("tags_t", text.TAG_SEPARATOR).alias("tag"),
        text.split_literal("tags_n", text.COUNT_SEPARATOR).alias("n"),
    )
    return (
        of_site(stage, site)
        .filter(F.col("tags_t").isNotNull())
        .select("work_refid", "site_logical_name", "tags_t", "tags_n")
        .distinct()
        .join(names, "site_logical_name")
        .select("work_refid", "source_site_id", F.explode_outer(pairs).alias("p"))
        .filter(F.col("p.tag").isNotNull())
        .groupBy("work_refid", F.col("p.tag").alias("tag"), "source_site_id")
        .agg(F.max(text.count_of("p.n")).alias("n"))
        .select("work_refid", ids.md5_uuid("tag").alias("tag_id"), "source_site_id", "n")
    )


def merge_work_tag(
    work_tag: DataFrame, stage: DataFrame, sites: DataFrame, now: str, batch_id: int, site: str | None = None
) -> DataFrame:
    """Frequency of tags per work and site; the highest where the stage has several."""
    return upsert(
        work_tag, _work_tags(stage, sites, site), ["work_refid", "tag_id", "source_site_id"],
        on_match={"frequency": F.col("s.n"), "update_dts": _time(now)},
        on_insert={"frequency": F.col("s.n"), **_new(now, batch_id)},
    )


def work_tag_touches(stage: DataFrame, sites: DataFrame, now: str, batch_id: int, site: str | None = None) -> DataFrame:
    """``merge_work_tag`` as touches."""
    count = {"frequency": F.col("n")}
    return _touches(
        "work_tag", _work_tags(stage, sites, site), now, batch_id, count, counted={**count, "update_dts": _time(now)})


def with_masters(work_sameas: DataFrame, harvested: DataFrame) -> DataFrame:
    """The given works and their masters (refid), each once."""
    asked = harvested.select("work_refid").distinct()
    masters = (
        work_sameas.filter(F.col("master_refid").isNotNull())
        .join(asked, "work_refid", "left_semi")
        .select(F.col("master_refid").alias("refid"))
    )
    return asked.select(F.col("work_refid").alias("refid")).union(masters).distinct()


def touch_last_harvest(work: DataFrame, work_sameas: DataFrame, harvested: DataFrame, now: str) -> DataFrame:
    """Set the harvest time on the given works and on their masters."""
    touched = with_masters(work_sameas, harvested)
    flagged = work.join(touched.withColumn("_hit", F.lit(True)), "refid", "left")
    kind = work.schema["last_harvest_dts"].dataType
    return flagged.withColumn(
        "last_harvest_dts",
        F.when(F.col("_hit"), F.lit(now).cast(kind)).otherwise(F.col("last_harvest_dts")),
    ).select(*work.columns)


def harvest_touches(work_sameas: DataFrame, harvested: DataFrame, now: str, batch_id: int) -> DataFrame:
    """``touch_last_harvest`` as touches: works that are not known stay unknown."""
    return _touches(
        "work", with_masters(work_sameas, harvested), now, batch_id, None, harvested={"last_harvest_dts": _time(now)})


def _mappings(stage: DataFrame, sites: DataFrame, site: str | None) -> DataFrame:
    names = sites.select(F.col("id").alias("site_id"), F.col("logical_name").alias("site_logical_name"))
    return (
        of_site(stage, site)
        .filter(F.col("work_uid").isNotNull())
        .groupBy("work_refid", "work_uid", "site_logical_name")
        .agg(F.max("title").alias("title"), F.max("authors").alias("authors"))
        .join(names, "site_logical_name")
    )


def merge_site_mapping(
    mapping: DataFrame, stage: DataFrame, sites: DataFrame, now: str, batch_id: int, site: str | None = None
) -> DataFrame:
    """Works found on other sites, one row per (work, uid, site); known ones are refreshed."""
    return upsert(
        mapping, _mappings(stage, sites, site), ["work_refid", "work_uid", "site_id"],
        on_match={"last_harvest_dts": _date(now)},
        on_insert={
            "last_harvest_dts": _date(now), "title": F.col("s.title"),
            "authors": F.col("s.authors"), **_new(now, batch_id),
        },
    )


def site_mapping_touches(
    stage: DataFrame, sites: DataFrame, now: str, batch_id: int, site: str | None = None
) -> DataFrame:
    """``merge_site_mapping`` as touches."""
    new = {"title": F.col("title"), "authors": F.col("authors"), "last_harvest_dts": _date(now)}
    return _touches(
        "work_site_mapping", _mappings(stage, sites, site), now, batch_id, new, seen={"last_harvest_dts": _date(now)})


def delete_batch(table: DataFrame, batch_id: int) -> DataFrame:
    """Everything but the rows of one load."""
    return table.filter(~F.col("load_audit_id").eqNullSafe(F.lit(batch_id)))
