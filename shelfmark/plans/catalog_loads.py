"""Registered merge queries: a stored state and a later feed, both cut by date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import ids
from shelfmark.operators import loads
from shelfmark.plans.registry import query
from shelfmark.plans.standins import FEED_START, NOW, STORED_END, Standins

OLD = "2010-01-01"
BATCH, OLD_BATCH = 2, 1

THING_ISBN = """(select l_partkey * 1000 + l_suppkey as work_refid,
       '978' || lpad(cast(l_orderkey * 10 + l_linenumber as varchar), 10, '0') as isbn13,
       case when l_linestatus = 'F' then '' else lpad(cast(l_orderkey * 10 + l_linenumber as varchar), 10, '0') end as isbn10,
       l_returnflag from {feed})"""


def thing_isbn(lines: DataFrame) -> DataFrame:
    number = F.lpad((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), 10, "0")
    return lines.select(
        (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("work_refid"),
        F.concat(F.lit("978"), number).alias("isbn13"),
        F.when(F.col("l_linestatus") == "F", F.lit("")).otherwise(number).alias("isbn10"),
        "l_returnflag",
    )


def _old_date() -> Column:
    return F.lit(OLD).cast("date")


def _old(df: DataFrame, *dates: str) -> DataFrame:
    df = df.withColumn("create_dts", F.lit(OLD).cast("timestamp_ntz")).withColumn(
        "load_audit_id", F.lit(OLD_BATCH)
    )
    for d in dates:
        df = df.withColumn(d, _old_date())
    return df


def _merged(key: str, cols: str, t: str, s: str) -> str:
    """SQL of the touch-or-insert shape over two key sets."""
    return f"""
    with t as ({t}), s as ({s})
    select {cols},
           case when s._k is null then date '{OLD}' else cast(timestamp '{NOW}' as date) end as last_seen_date,
           case when t._k is null then timestamp '{NOW}' else timestamp '{OLD}' end as create_dts,
           cast(case when t._k is null then {BATCH} else {OLD_BATCH} end as int) as load_audit_id
    from t full join s on {key}"""


@query("merge_work", _merged(
    "t._k = s._k", "coalesce(t._k, s._k) as refid",
    "select distinct work_refid as _k from " + THING_ISBN.format(feed="stored_feed"),
    "select distinct work_refid as _k from " + THING_ISBN.format(feed="new_feed")))
def merge_work(s: Standins):
    stored = _old(
        thing_isbn(s.stored_feed()).select(F.col("work_refid").alias("refid")).distinct(), "last_seen_date"
    )
    return loads.merge_work(stored, thing_isbn(s.new_feed()), NOW, BATCH)


@query("merge_isbn", _merged(
    "t._k = s._k", "coalesce(t._k, s._k) as ean, coalesce(t.isbn13, s.isbn13) as isbn13, "
    "case when t._k is null then s.isbn10 else t.isbn10 end as isbn10",
    "select cast(isbn13 as bigint) as _k, isbn13, min(isbn10) as isbn10 from "
    + THING_ISBN.format(feed="stored_feed") + " group by 1, 2",
    "select cast(isbn13 as bigint) as _k, isbn13, max(isbn10) as isbn10 from "
    + THING_ISBN.format(feed="new_feed") + " group by 1, 2"))
def merge_isbn(s: Standins):
    stored = thing_isbn(s.stored_feed()).groupBy(
        F.col("isbn13").cast("long").alias("ean"), "isbn13"
    ).agg(F.min("isbn10").alias("isbn10"))
    return loads.merge_isbn(_old(stored, "last_seen_date"), thing_isbn(s.new_feed()), NOW, BATCH)


_CLEAN = """select min(work_refid) as work_refid, cast(isbn13 as bigint) as ean,
       case when min(l_returnflag) = 'A' then date '{old}' end as deletion_date
       from {feed} group by isbn13 having count(*) = 1"""


@query("sync_work_isbn", f"""
    with t as ({_CLEAN.format(old=OLD, feed=THING_ISBN.format(feed='stored_feed'))}),
         s as ({_CLEAN.format(old=OLD, feed=THING_ISBN.format(feed='new_feed'))})
    select coalesce(t.work_refid, s.work_refid) as work_refid, coalesce(t.ean, s.ean) as ean,
           case when s.ean is null then date '{OLD}' else cast(timestamp '{NOW}' as date) end as last_seen_date,
           case when s.ean is null then cast(timestamp '{NOW}' as date) end as deletion_date,
           case when t.ean is null then timestamp '{NOW}' else timestamp '{OLD}' end as create_dts,
           cast(case when t.ean is null then {BATCH} else {OLD_BATCH} end as int) as load_audit_id
    from t full join s on t.ean = s.ean and t.work_refid = s.work_refid""")
def sync_work_isbn(s: Standins):
    feed = thing_isbn(s.stored_feed())
    deleted = feed.groupBy(F.col("isbn13").cast("long").alias("ean")).agg(
        F.when(F.min("l_returnflag") == "A", _old_date()).alias("deletion_date")
    )
    stored = loads.unambiguous_isbns(feed).join(deleted, "ean")
    return loads.sync_work_isbn(_old(stored, "last_seen_date"), thing_isbn(s.new_feed()), NOW, BATCH)


@query("merge_isbn_lang", f"""
    with t as (select l_orderkey as ean, min(l_returnflag) as lang_code from stored_feed group by 1),
         s as (select l_orderkey as ean, max(l_linestatus) as lang_code from new_feed group by 1)
    select coalesce(t.ean, s.ean) as ean, coalesce(s.lang_code, t.lang_code) as lang_code,
           case when t.ean is not null and s.ean is not null then timestamp '{NOW}' end as update_dts,
           case when t.ean is null then timestamp '{NOW}' else timestamp '{OLD}' end as create_dts,
           cast(case when t.ean is null then {BATCH} else {OLD_BATCH} end as int) as load_audit_id
    from t full join s on t.ean = s.ean""")
def merge_isbn_lang(s: Standins):
    stored = s.stored_feed().groupBy(F.col("l_orderkey").alias("ean")).agg(
        F.min("l_returnflag").alias("lang_code")
    ).withColumn("update_dts", F.lit(None).cast("timestamp_ntz"))
    stage = s.new_feed().select(
        F.col("l_orderkey").cast("string").alias("ean"), F.col("l_linestatus").alias("lang_code")
    )
    return loads.merge_isbn_lang(_old(stored), stage, NOW, BATCH)


@query("insert_missing_work", f"""
    select distinct l_partkey * 1000 + l_suppkey as refid, timestamp '{NOW}' as create_dts,
           cast({BATCH} as int) as load_audit_id, cast(timestamp '{NOW}' as date) as last_seen_date
    from new_feed n where not exists (select 1 from stored_feed t
         where t.l_partkey * 1000 + t.l_suppkey = n.l_partkey * 1000 + n.l_suppkey)""")
def insert_missing_work(s: Standins):
    stored = thing_isbn(s.stored_feed()).select(F.col("work_refid").alias("refid")).distinct()
    return loads.insert_missing_work(stored, thing_isbn(s.new_feed()), NOW, BATCH)


# The stored side of the work-info loads: the more popular works were loaded before.
_KNOWN = "p_size < 25"
_STAMP = f"timestamp '{NOW}' as create_dts, cast({BATCH} as int) as load_audit_id"


def _known(s: Standins) -> DataFrame:
    return s.raw("part").filter(F.col("p_size") < 25)


@query("insert_work_info", f"""
    select w.work_refid, w.title, w.original_lang, w.ori_lang_code,
           replace(coalesce(mds_code_corr, mds_code), '.', '') as mds_code, mds_code as mds_code_ori,
           lc_subjects, cast(replace(popularity, ',', '') as int) as popularity, {_STAMP}
    from staged_works w where work_refid not in (select p_partkey from part where {_KNOWN})""")
def insert_work_info(s: Standins):
    stored = _known(s).select(F.col("p_partkey").alias("work_refid"))
    return loads.insert_work_info(stored, s.staged_works(), NOW, BATCH)


_CODES = "(select work_refid, unnest(string_split(authors_code, ';')) as code, unnest(string_split(authors, ';')) as name from staged_works)"


@query("insert_author", f"""
    select distinct cast(md5(code)::uuid as varchar) as id, code, {_STAMP}
    from {_CODES} c where code not in (select replace(p_name, ' ', '') from part where {_KNOWN})
    and code not in (select lower(p_type) from part where {_KNOWN})""")
def insert_author(s: Standins):
    known = _known(s)
    stored = known.select(F.replace("p_name", F.lit(" "), F.lit("")).alias("code")).union(
        known.select(F.lower("p_type"))
    ).distinct()
    return loads.insert_author(stored, s.staged_works(), NOW, BATCH)


@query("insert_author_info", f"""
    select cast(md5(code)::uuid as varchar) as author_id, max(name) as name, {_STAMP}
    from {_CODES} c where code is not null
    and code not in (select lower(p_type) from part where {_KNOWN}) group by code""")
def insert_author_info(s: Standins):
    stored = _known(s).select(ids.md5_uuid(F.lower("p_type")).alias("author_id")).distinct()
    return loads.insert_author_info(stored, s.staged_works(), NOW, BATCH)


@query("insert_work_author", f"""
    select distinct cast(md5(code)::uuid as varchar) as author_id, work_refid, {_STAMP}
    from {_CODES} c where (work_refid, code) not in (select p_partkey, lower(p_type) from part where {_KNOWN})""")
def insert_work_author(s: Standins):
    stored = _known(s).select(
        ids.md5_uuid(F.lower("p_type")).alias("author_id"), F.col("p_partkey").alias("work_refid")
    )
    return loads.insert_work_author(stored, s.staged_works(), NOW, BATCH)


@query("insert_work_sameas", f"""
    select distinct dup_refid as work_refid, work_refid as master_refid, {_STAMP}
    from staged_works where dup_refid is not null
    and work_refid not in (select p_partkey from part where {_KNOWN})""")
def insert_work_sameas(s: Standins):
    stored = _known(s).select(
        (F.col("p_partkey") + 1000000).alias("work_refid"), F.col("p_partkey").alias("master_refid")
    )
    return loads.insert_work_sameas(stored, s.staged_works(), NOW, BATCH)


@query("insert_work_sameas_reviews", f"""
    select distinct dup_refid as work_refid, work_refid as master_refid, {_STAMP}
    from staged_reviews r where dup_refid is not null and l_shipdate >= timestamp '{FEED_START}'
    and not exists (select 1 from staged_reviews t where t.dup_refid = r.dup_refid
        and t.work_refid = r.work_refid and t.l_shipdate < timestamp '{STORED_END}')""")
def insert_work_sameas_reviews(s: Standins):
    old, new = _review_feeds(s)
    stored = old.filter(F.col("dup_refid").isNotNull()).select(
        F.col("dup_refid").alias("work_refid"), F.col("work_refid").alias("master_refid")
    ).distinct()
    return loads.insert_work_sameas(stored, new, NOW, BATCH)


@query("insert_mds", f"""
    select replace(dotted, '.', '') as code, dotted as code_w_dot, max(mds_text) as mds_text, {_STAMP}
    from (select coalesce(mds_code_corr, mds_code) as dotted, mds_text from staged_works) w
    where dotted is not null and replace(dotted, '.', '') not in (select code from mds) group by dotted""")
def insert_mds(s: Standins):
    return loads.insert_mds(s.mds(), s.staged_works(), NOW, BATCH)


@query("insert_work_title", f"""
    with split as (select work_refid, string_split(unnest(string_split(other_lang_title, '__&__')), ':') as p
                   from staged_works),
    titles as (select work_refid, trim(p[1]) as lang_text, trim(array_to_string(p[2:5], '')) as title from split)
    select t.work_refid, l.code as lang_code, t.lang_text, t.title, {_STAMP}
    from titles t left join language l on upper(l.english_name) = upper(t.lang_text)
    where length(t.lang_text) > 1 and not (t.lang_text = 'Klingon'
          and t.work_refid in (select p_partkey from part where {_KNOWN}))""")
def insert_work_title(s: Standins):
    stored = _known(s).select(F.col("p_partkey").alias("work_refid"), F.lit("Klingon").alias("lang_text"))
    return loads.insert_work_title(stored, s.staged_works(), s.language(), NOW, BATCH)


# -- reviews -------------------------------------------------------------------------


def _review_feeds(s: Standins) -> tuple[DataFrame, DataFrame]:
    staged = s.staged_reviews()
    end = F.lit(STORED_END).cast("timestamp_ntz")
    start = F.lit(FEED_START).cast("timestamp_ntz")
    return staged.filter(F.col("l_shipdate") < end), staged.filter(F.col("l_shipdate") >= start)


_OLD_STAGE = f"staged_reviews where l_shipdate < timestamp '{STORED_END}'"
_NEW_STAGE = f"staged_reviews where l_shipdate >= timestamp '{FEED_START}'"
_USERS = """select cast(md5(concat(user_uid, site_logical_name))::uuid as varchar) as _k, user_uid,
       site_logical_name, {pick}(username) as username from {stage} and user_uid is not null
       group by user_uid, site_logical_name"""


@query("merge_user", _merged(
    "t._k = s._k left join site x on x.logical_name = coalesce(t.site_logical_name, s.site_logical_name)",
    "coalesce(t._k, s._k) as id, coalesce(t.user_uid, s.user_uid) as user_uid, x.id as site_id, "
    "case when t._k is null then s.username else t.username end as username",
    _USERS.format(pick="min", stage=_OLD_STAGE), _USERS.format(pick="max", stage=_NEW_STAGE)))
def merge_user(s: Standins):
    old, new = _review_feeds(s)
    sites = s.site()
    stored = (
        old.filter(F.col("user_uid").isNotNull())
        .groupBy("site_logical_name", "user_uid").agg(F.min("username").alias("username"))
        .join(sites.withColumnsRenamed({"id": "site_id", "logical_name": "site_logical_name"}), "site_logical_name")
        .select(ids.derive_user_id("user_uid", "site_logical_name").alias("id"), "user_uid", "site_id", "username")
    )
    return loads.merge_user(_old(stored, "last_seen_date"), new, sites, NOW, BATCH)


@query("append_review", f"""
    select r.work_refid, cast(md5(concat(user_uid, site_logical_name))::uuid as varchar) as user_id,
           s.id as site_id, cast(rating_n as varchar) || '.0 out of 10' as rating, rating_n as parsed_rating,
           cast(likes_n as varchar) || ' likes' as likes, likes_n as parsed_likes,
           title as review, parsed_review_date as review_date, review_lang, {_STAMP}
    from staged_reviews r join site s on s.logical_name = r.site_logical_name where user_uid is not null""")
def append_review(s: Standins):
    stage = s.staged_reviews().select(
        "work_refid", "site_logical_name", "user_uid", "parsed_review_date", "review_lang",
        F.concat(F.col("rating_n").cast("string"), F.lit(".0 out of 10")).alias("rating"),
        F.concat(F.col("rating_n").cast("string"), F.lit(".0")).alias("parsed_rating"),
        F.concat(F.col("likes_n").cast("string"), F.lit(" likes")).alias("likes"),
        F.col("likes_n").cast("string").alias("parsed_likes"),
        F.col("title").alias("review"),
    )
    return loads.append_review(stage, s.site(), NOW, BATCH)


@query("insert_tag", f"""
    with s as (select unnest(string_split(tags_t, '__&__')) as tag, tags_lang, x.id as site_id
               from (select * from {_NEW_STAGE} and tags_t is not null) r
               join site x on x.logical_name = r.site_logical_name)
    select cast(md5(tag)::uuid as varchar) as id, tag, upper(tag) as tag_upper, min(site_id) as ori_site_id,
           max(tags_lang) as lang_code, {_STAMP}
    from s where tag not in (select lower(p_type) from part where {_KNOWN}) group by tag""")
def insert_tag(s: Standins):
    stored = _known(s).select(ids.md5_uuid(F.lower("p_type")).alias("id")).distinct()
    return loads.insert_tag(stored, _review_feeds(s)[1], s.site(), NOW, BATCH)


_TAGS = """select work_refid, cast(md5(tag)::uuid as varchar) as tag_id, site_logical_name,
       {pick}(cast(trim(replace(n, ',', '')) as int)) as n
       from (select work_refid, site_logical_name, unnest(string_split(tags_t, '__&__')) as tag,
                    unnest(string_split(tags_n, ';')) as n from {stage} and tags_t is not null) u
       group by work_refid, tag, site_logical_name"""


@query("merge_work_tag", f"""
    with t as ({_TAGS.format(pick='min', stage=_OLD_STAGE)}), s as ({_TAGS.format(pick='max', stage=_NEW_STAGE)})
    select coalesce(t.work_refid, s.work_refid) as work_refid, coalesce(t.tag_id, s.tag_id) as tag_id,
           x.id as source_site_id, case when s.tag_id is null then t.n else s.n end as frequency,
           case when t.tag_id is not null and s.tag_id is not null then timestamp '{NOW}' end as update_dts,
           case when t.tag_id is null then timestamp '{NOW}' else timestamp '{OLD}' end as create_dts,
           cast(case when t.tag_id is null then {BATCH} else {OLD_BATCH} end as int) as load_audit_id
    from t full join s on t.work_refid = s.work_refid and t.tag_id = s.tag_id
         and t.site_logical_name = s.site_logical_name
    join site x on x.logical_name = coalesce(t.site_logical_name, s.site_logical_name)""")
def merge_work_tag(s: Standins):
    from shelfmark.functions import text

    old, new = _review_feeds(s)
    sites = s.site()
    pairs = F.arrays_zip(
        F.split("tags_t", "__&__").alias("tag"), F.split("tags_n", ";").alias("n")
    )
    stored = (
        old.filter(F.col("tags_t").isNotNull())
        .select("work_refid", "site_logical_name", "tags_t", "tags_n")
        .distinct()
        .join(sites.withColumnsRenamed({"id": "source_site_id", "logical_name": "site_logical_name"}), "site_logical_name")
        .select("work_refid", "source_site_id", F.explode_outer(pairs).alias("p"))
        .groupBy("work_refid", ids.md5_uuid("p.tag").alias("tag_id"), "source_site_id")
        .agg(F.min(text.count_of("p.n")).alias("frequency"))
        .withColumn("update_dts", F.lit(None).cast("timestamp_ntz"))
    )
    return loads.merge_work_tag(_old(stored), new, sites, NOW, BATCH)


@query("touch_last_harvest", f"""
    with asked as (select distinct l_partkey as work_refid from lineitem
                   where l_shipdate >= timestamp '2001-08-01'),
    touched as (select work_refid as refid from asked union
                select master_refid from work_sameas where work_refid in (select work_refid from asked))
    select refid, case when refid in (select refid from touched) then cast(timestamp '{NOW}' as date)
           else last_harvest_dts end as last_harvest_dts from work""")
def touch_last_harvest(s: Standins):
    asked = s.raw("lineitem").filter(
        F.col("l_shipdate") >= F.lit("2001-08-01").cast("timestamp_ntz")
    ).select(F.col("l_partkey").alias("work_refid"))
    return loads.touch_last_harvest(s.work(), s.work_sameas(), asked, NOW)


_MAP = """select work_refid, work_uid, site_logical_name, {pick}(title) as title, {pick}(authors) as authors
       from {stage} group by 1, 2, 3"""


@query("merge_site_mapping", f"""
    with t as ({_MAP.format(pick='min', stage=_OLD_STAGE)}), s as ({_MAP.format(pick='max', stage=_NEW_STAGE)})
    select coalesce(t.work_refid, s.work_refid) as work_refid, coalesce(t.work_uid, s.work_uid) as work_uid,
           x.id as site_id, case when t.work_uid is null then s.title else t.title end as title,
           case when t.work_uid is null then s.authors else t.authors end as authors,
           case when s.work_uid is null then date '{OLD}' else cast(timestamp '{NOW}' as date) end as last_harvest_dts,
           case when t.work_uid is null then timestamp '{NOW}' else timestamp '{OLD}' end as create_dts,
           cast(case when t.work_uid is null then {BATCH} else {OLD_BATCH} end as int) as load_audit_id
    from t full join s on t.work_refid = s.work_refid and t.work_uid = s.work_uid
         and t.site_logical_name = s.site_logical_name
    join site x on x.logical_name = coalesce(t.site_logical_name, s.site_logical_name)""")
def merge_site_mapping(s: Standins):
    old, new = _review_feeds(s)
    sites = s.site()
    stored = (
        old.groupBy("work_refid", "work_uid", "site_logical_name")
        .agg(F.min("title").alias("title"), F.min("authors").alias("authors"))
        .join(sites.withColumnsRenamed({"id": "site_id", "logical_name": "site_logical_name"}), "site_logical_name")
        .drop("site_logical_name")
    )
    return loads.merge_site_mapping(_old(stored, "last_harvest_dts"), new, sites, NOW, BATCH)


@query("delete_batch", """
    select work_refid, user_id, parsed_rating, review_date, load_audit_id from review_r
    where load_audit_id <> 1997""")
def delete_batch(s: Standins):
    return loads.delete_batch(
        s.review_r(with_user=False).select(
            "work_refid", "user_id", "parsed_rating", "review_date", "load_audit_id"
        ),
        1997,
    )
