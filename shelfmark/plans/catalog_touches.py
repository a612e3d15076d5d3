"""Registered queries over tables kept as touches.

Two feeds are loaded into an empty log, as the flows do it, and the table is read back. The
second feed overlaps the first. The SQL states the rows by key, from both feeds at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.operators import loads
from shelfmark.plans.catalog_loads import (
    BATCH, OLD, OLD_BATCH, THING_ISBN, _MAP, _NEW_STAGE, _OLD_STAGE, _TAGS, _USERS, _review_feeds, thing_isbn,
)
from shelfmark.plans.catalog_sources import _folder
from shelfmark.plans.registry import query
from shelfmark.plans.standins import NOW, Standins
from shelfmark.plans.tables import TOUCHED, layout
from shelfmark.sources.touches import TouchLog

BETWEEN, LATER = "2015-06-01 00:00:00", "2020-02-01 00:00:00"
OLD_TIME = f"{OLD} 00:00:00"


def _log(s: Standins, name: str) -> TouchLog:
    return TouchLog(s.spark, _folder(s, name), layout(name), TOUCHED[name])


def _rows(cols: str, join: str, t: str, s: str) -> str:
    """SQL of a table's rows after two loads; t holds the first load's keys, s the second's."""
    return f"""
    with t as ({t}), s as ({s})
    select {cols},
           case when t._k is null then timestamp '{NOW}' else timestamp '{OLD}' end as create_dts,
           cast(case when t._k is null then {BATCH} else {OLD_BATCH} end as int) as load_audit_id
    from t full join s on {join}"""


_SEEN = f"case when s._k is null then date '{OLD}' else cast(timestamp '{NOW}' as date) end"
_WORKS = "select distinct work_refid as _k from " + THING_ISBN


@query("touched_work", f"""
    with t as ({_WORKS.format(feed='stored_feed')}), s as ({_WORKS.format(feed='new_feed')}),
    harvested as (select distinct l_partkey * 1000 + l_suppkey as _k from lineitem where l_linenumber = 1)
    select coalesce(t._k, s._k) as refid, {_SEEN} as last_seen_date,
           case when h._k is not null and t._k is not null then timestamp '{BETWEEN}' end as last_harvest_dts,
           case when t._k is null then timestamp '{NOW}' else timestamp '{OLD}' end as create_dts,
           cast(case when t._k is null then {BATCH} else {OLD_BATCH} end as int) as load_audit_id
    from t full join s on t._k = s._k left join harvested h on h._k = coalesce(t._k, s._k)""")
def touched_work(s: Standins):
    """Loads that arrive out of order, one of them twice, with a fold between, and one taken back.

    Works are harvested between the two feeds: those only in the second are not known yet and
    stay unharvested.
    """
    log, nobody = _log(s, "work"), s.spark.createDataFrame([], "work_refid bigint, master_refid bigint")
    old, new = thing_isbn(s.stored_feed()), thing_isbn(s.new_feed())
    harvested = s.raw("lineitem").filter("l_linenumber = 1").select(
        (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("work_refid"))
    log.append(BATCH, loads.work_touches(new, NOW, BATCH))
    log.append(3, loads.harvest_touches(nobody, harvested, BETWEEN, 3))
    log.fold()
    log.append(OLD_BATCH, loads.work_touches(old, OLD_TIME, OLD_BATCH))
    # Too early for any work: nothing is known before the first feed.
    log.append(4, loads.harvest_touches(nobody, harvested, "2009-01-01 00:00:00", 4))
    log.append(5, loads.missing_work_touches(new, LATER, 5))
    log.append(6, loads.work_touches(new, LATER, 6))
    log.append(BATCH, loads.work_touches(new, NOW, BATCH))
    log.drop(6)
    return log.read()


_ISBNS = """select cast(isbn13 as bigint) as _k, max(isbn13) as isbn13, max(isbn10) as isbn10
       from {feed} group by 1"""


@query("touched_isbn", _rows(
    f"coalesce(t._k, s._k) as ean, coalesce(t.isbn13, s.isbn13) as isbn13, {_SEEN} as last_seen_date, "
    "case when t._k is null then s.isbn10 else t.isbn10 end as isbn10", "t._k = s._k",
    _ISBNS.format(feed=THING_ISBN.format(feed="stored_feed")), _ISBNS.format(feed=THING_ISBN.format(feed="new_feed"))))
def touched_isbn(s: Standins):
    log = _log(s, "isbn")
    log.append(OLD_BATCH, loads.isbn_touches(thing_isbn(s.stored_feed()), OLD_TIME, OLD_BATCH))
    log.append(BATCH, loads.isbn_touches(thing_isbn(s.new_feed()), NOW, BATCH))
    return log.read()


@query("touched_isbn_lang", _rows(
    "coalesce(t._k, s._k) as ean, case when s._k is null then t.lang_code else s.lang_code end as lang_code, "
    f"case when t._k is not null and s._k is not null then timestamp '{NOW}' end as update_dts", "t._k = s._k",
    "select l_orderkey as _k, max(l_returnflag) as lang_code from stored_feed group by 1",
    "select l_orderkey as _k, max(l_linestatus) as lang_code from new_feed group by 1"))
def touched_isbn_lang(s: Standins):
    log = _log(s, "isbn_info")
    for feed, code, at, batch in ((s.stored_feed(), "l_returnflag", OLD_TIME, OLD_BATCH), (s.new_feed(), "l_linestatus", NOW, BATCH)):
        stage = feed.select(F.col("l_orderkey").cast("string").alias("ean"), F.col(code).alias("lang_code"))
        log.append(batch, loads.isbn_lang_touches(stage, at, batch))
        log.fold()
    return log.read()


def _loaded(s: Standins, name: str, load) -> DataFrame:
    """A log with the old and the new review stage, a fold between them."""
    log, (old, new) = _log(s, name), _review_feeds(s)
    log.append(OLD_BATCH, load(old, s.site(), OLD_TIME, OLD_BATCH))
    log.fold()
    log.append(BATCH, load(new, s.site(), NOW, BATCH))
    return log.read()


@query("touched_user", _rows(
    "coalesce(t._k, s._k) as id, coalesce(t.user_uid, s.user_uid) as user_uid, x.id as site_id, "
    f"case when t._k is null then s.username else t.username end as username, {_SEEN} as last_seen_date",
    "t._k = s._k left join site x on x.logical_name = coalesce(t.site_logical_name, s.site_logical_name)",
    _USERS.format(pick="max", stage=_OLD_STAGE), _USERS.format(pick="max", stage=_NEW_STAGE)))
def touched_user(s: Standins):
    return _loaded(s, "user", loads.user_touches)


@query("touched_work_tag", _rows(
    "coalesce(t.work_refid, s.work_refid) as work_refid, coalesce(t.tag_id, s.tag_id) as tag_id, "
    "x.id as source_site_id, case when s._k is null then t.n else s.n end as frequency, "
    f"case when t._k is not null and s._k is not null then timestamp '{NOW}' end as update_dts",
    "t._k = s._k and t.work_refid = s.work_refid and t.site_logical_name = s.site_logical_name "
    "join site x on x.logical_name = coalesce(t.site_logical_name, s.site_logical_name)",
    f"select *, tag_id as _k from ({_TAGS.format(pick='max', stage=_OLD_STAGE)}) u",
    f"select *, tag_id as _k from ({_TAGS.format(pick='max', stage=_NEW_STAGE)}) u"))
def touched_work_tag(s: Standins):
    return _loaded(s, "work_tag", loads.work_tag_touches)


@query("touched_site_mapping", _rows(
    "coalesce(t.work_refid, s.work_refid) as work_refid, coalesce(t._k, s._k) as work_uid, x.id as site_id, "
    "case when t._k is null then s.title else t.title end as title, "
    f"case when t._k is null then s.authors else t.authors end as authors, {_SEEN} as last_harvest_dts",
    "t._k = s._k and t.work_refid = s.work_refid and t.site_logical_name = s.site_logical_name "
    "join site x on x.logical_name = coalesce(t.site_logical_name, s.site_logical_name)",
    f"select *, work_uid as _k from ({_MAP.format(pick='max', stage=_OLD_STAGE)}) u",
    f"select *, work_uid as _k from ({_MAP.format(pick='max', stage=_NEW_STAGE)}) u"))
def touched_site_mapping(s: Standins):
    return _loaded(s, "work_site_mapping", loads.site_mapping_touches)
