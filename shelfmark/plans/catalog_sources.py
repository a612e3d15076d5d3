"""Registered source and sink queries: files are written from the given tables, then read.

Files go to the folder the cluster shares, a fresh one per run.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions import fields, ids
from shelfmark.operators import loads, star
from shelfmark.plans.catalog_normalize import SITE_SQL, raw_date, raw_likes, raw_link, raw_rating, site_name
from shelfmark.plans.flows import Warehouse
from shelfmark.plans.registry import query
from shelfmark.plans.standins import NOW, Standins
from shelfmark.session import shared_folder
from shelfmark.sources import delimited, feeds, ledger, pages
from shelfmark.sources.tables import Store, materialize, read_by_pattern
from shelfmark.streaming import ingest, reviews


def _folder(s: Standins, name: str) -> str:
    return f"{shared_folder(s.spark)}/{name}-{uuid.uuid4().hex}"


@query("read_isbn_feed", """
    with i as (select l_partkey as work_refid, lpad(cast(l_orderkey as varchar), 9, '0') as d, l_returnflag,
                      l_linestatus, l_linenumber from lineitem),
    n as (select *, '978' || d as b from i where l_returnflag <> 'R')
    select work_refid, case when l_linestatus = 'F' then d || 'X' else '9790' || d end as isbn_ori,
           case when l_linestatus = 'F' then d || 'X' else '' end as isbn10,
           case when l_linestatus = 'F' then b || cast((10 - (list_sum(list_transform(range(1, 13),
               lambda k: cast(substr(b, k, 1) as int) * case when k % 2 = 1 then 1 else 3 end))::bigint % 10)) % 10 as varchar)
               else '9790' || d end as isbn13
    from n where l_linenumber < 7""")
def read_isbn_feed(s: Standins):
    number = F.lpad(F.col("l_orderkey").cast("string"), 9, "0")
    isbn = (
        F.when(F.col("l_linenumber") == 7, F.lit("12345"))
        .when(F.col("l_linestatus") == "F", F.concat(number, F.lit("X")))
        .otherwise(F.concat(F.lit("9790"), number))
    )
    mark = F.when(F.col("l_returnflag") == "R", F.lit("true"))
    works = s.raw("lineitem").select(
        F.col("l_partkey").alias("_workcode"),
        F.array(F.struct(isbn.alias("_VALUE"), mark.alias("_uncertain"))).alias("isbn"),
    )
    path = _folder(s, "feed")
    works.write.format("xml").options(rootTag="feed", rowTag="work", compression="gzip").save(path)
    return feeds.read_isbn_feed(s.spark, path)


@query("read_headered_dump", """
    select cast(doc_id as varchar) as work_refid, "text" as review, lang as review_lang,
           case when lang = 'fr' then null when lang = 'de' then '' else source end as title from documents""")
def read_headered_dump(s: Standins):
    """Texts with line breaks, quotes and delimiters; NULL against empty text."""
    title = F.when(F.col("lang") == "fr", F.lit(None)).when(F.col("lang") == "de", "").otherwise(F.col("source"))
    rows = s.raw("documents").select(
        title.alias("title"), F.col("text").alias("review"),
        F.col("doc_id").cast("string").alias("work_refid"), F.col("lang").alias("review_lang"),
    )
    path = _folder(s, "dump")
    rows.write.csv(path, sep="|", header=True, quote='"', escape='"', nullValue="", emptyValue='""')
    columns = ("site_logical_name", "work_refid", "review", "review_lang", "title")
    return delimited.read_headered_dump(s.spark, path, columns).drop("site_logical_name")


@query("read_headers_in_two_orders", """
    select cast(o_orderkey as varchar) as work_refid, o_orderpriority as title, case when o_orderstatus = 'F' then
           cast(o_custkey as varchar) end as popularity from orders""")
def read_headers_in_two_orders(s: Standins):
    """Two lots of files that name the same columns in different orders, one without one of them."""
    orders = s.raw("orders").select(
        F.col("o_orderkey").cast("string").alias("work_refid"), F.col("o_orderpriority").alias("title"),
        F.col("o_custkey").cast("string").alias("popularity"), "o_orderstatus",
    )
    path, settled = _folder(s, "dump"), F.col("o_orderstatus") == "F"
    for lot in (
        orders.filter(settled).select("popularity", "title", "work_refid"),
        orders.filter(~settled).select("work_refid", "title"),
    ):
        lot.write.mode("append").csv(path, sep="|", header=True, quote='"', escape='"')
    return delimited.read_headered_dump(s.spark, path, ("work_refid", "title", "popularity"))


_ALL_WORKS = "select p_partkey as work_refid, count(*) as nb from part group by 1"


@query("empty_input_guard", _ALL_WORKS)
def empty_input_guard(s: Standins):
    """A dump is loaded; an empty one under another task neither adds rows nor loads the old stage again."""
    house = Warehouse(s.spark, _folder(s, "warehouse"))
    for task, staged in (("first", s.staged_works()), ("second", s.staged_works().limit(0))):
        path = _folder(s, "dump")
        staged.write.csv(path, sep="|", header=True, quote='"', escape='"', nullValue="")
        house.load_work_info(path, task, datetime.fromisoformat(NOW))
    return house.table("work_info").groupBy("work_refid").agg(F.count(F.lit(1)).alias("nb"))


@query("repeat_insert_load", _ALL_WORKS)
def repeat_insert_load(s: Standins):
    """An insert load repeated under its own id with a stage that has grown leaves the whole stage, once."""
    house = Warehouse(s.spark, _folder(s, "warehouse"))
    staged = s.staged_works()
    for stage in (staged.filter("popularity >= '25'"), staged):
        rows = loads.insert_work_info(house.before("work_info", 7), stage, NOW, 7)
        house._append("work_info", rows, 7)
    return house.table("work_info").groupBy("work_refid").agg(F.count(F.lit(1)).alias("nb"))


@query("read_plain_dump", """
    select cast(l_partkey as varchar) as work_refid, cast(l_orderkey as varchar) as isbn_ori,
           case when l_linestatus = 'F' then null else l_returnflag end as isbn10, l_linestatus as isbn13
    from lineitem""")
def read_plain_dump(s: Standins):
    ten = F.when(F.col("l_linestatus") == "F", F.lit("\\N")).otherwise(F.col("l_returnflag"))
    lines = s.raw("lineitem").select(
        F.concat_ws("|", F.col("l_partkey").cast("string"), F.col("l_orderkey").cast("string"), ten, "l_linestatus")
    )
    path = _folder(s, "plain")
    lines.write.text(path)
    return delimited.read_plain_dump(s.spark, path, ("work_refid", "isbn_ori", "isbn10", "isbn13"))


@query("load_language_ref", """
    select 'x' || lpad(cast(n_nationkey as varchar), 2, '0') as code3, n_name as english_name from nation""")
def load_language_ref(s: Standins):
    known = s.language()
    lines = known.select(
        F.concat_ws("\t", "code3", "code3", "code2", "code", "english_name", "english_name", "french_name", "french_name")
    )
    path = _folder(s, "languages")
    lines.write.text(path)
    loaded = delimited.load_language_ref(s.spark, path, known.limit(0))
    return loaded.select("code3", "english_name")


@query("export_delimited", """
    select doc_id, replace("text" || '| end \\n', '|', ' ') as review,
           case when lang = 'en' then null else lang end as lang_code from documents""")
def export_delimited(s: Standins):
    rows = s.raw("documents").select(
        "doc_id",
        F.concat(F.col("text"), F.lit("| end \\n")).alias("review"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("lang_code"),
    )
    path = _folder(s, "export")
    delimited.export_delimited(rows, path, delimited.EXPORT_REPLACEMENTS["review"], compress=True)
    return delimited.read_tolerant(s.spark, path, "doc_id bigint, review string, lang_code string")


@query("export_star_table", """
    select row_number() over (order by code) as author_id, code, replace(name || '|' || code, '|', ',') as name from author""")
def export_star_table(s: Standins):
    """A dimension as the star export writes it, read back."""
    codes = s.author().select(ids.md5_uuid("code").alias("id"), "code")
    names = s.author().select(ids.md5_uuid("code").alias("author_id"), F.concat_ws("|", "name", "code").alias("name"))
    path = _folder(s, "export")
    delimited.export_delimited(star.dim_author(codes, names), path, delimited.EXPORT_REPLACEMENTS["dim_author"])
    return delimited.read_tolerant(s.spark, path, "author_id bigint, code string, name string")


@query("read_tolerant_bad_rows", """
    select o_orderkey, o_totalprice from orders where o_orderkey % 1000 <> 7""")
def read_tolerant_bad_rows(s: Standins):
    """Rows with too few fields are dropped while they are within the tolerated number."""
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"))
    broken = F.concat(F.lit("damaged "), F.col("o_orderkey").cast("string"))
    path = _folder(s, "lines")
    s.raw("orders").select(F.when(F.col("o_orderkey") % 1000 == 7, broken).otherwise(line).alias("value")).write.text(path)
    return delimited.read_tolerant(s.spark, path, "o_orderkey bigint, o_totalprice double", max_errors=1_000_000)


@query("rejected_lines", """
    with lines as (
        select case when o_orderstatus = 'P' then o_orderkey || '|' || o_custkey
                    when o_orderpriority = '1-URGENT' then o_orderkey || '|c' || o_custkey || '|' || o_orderpriority
                    when o_orderpriority = '5-LOW' then '' || '|' || o_custkey || '|' || o_orderpriority
                    else o_orderkey || '|' || o_custkey || '|' || o_orderpriority end as line
        from orders),
    parted as (select line, string_split(line, '|') as cells from lines)
    select line, case when len(cells) <> 3 then 'number of fields' else 'value' end as reason,
           case when len(cells) <> 3 then null when try_cast(cells[1] as bigint) is null then 'o_orderkey'
                else 'o_custkey' end as field
    from parted where len(cells) <> 3 or try_cast(cells[1] as bigint) is null or try_cast(cells[2] as bigint) is null""")
def rejected_lines(s: Standins):
    """Lines with a field too few, or with a field that does not convert, kept with their reason."""
    key, who = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    line = (
        F.when(F.col("o_orderstatus") == "P", F.concat_ws("|", key, who))
        .when(F.col("o_orderpriority") == "1-URGENT", F.concat_ws("|", key, F.concat(F.lit("c"), who), "o_orderpriority"))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat_ws("|", F.lit(""), who, "o_orderpriority"))
        .otherwise(F.concat_ws("|", key, who, "o_orderpriority"))
    )
    path = _folder(s, "lines")
    s.raw("orders").select(line.alias("value")).write.text(path)
    _, rejects, _ = delimited.read_with_rejects(s.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderpriority string")
    return rejects.select("line", "reason", "field")


@query("read_by_pattern", "select distinct 'order-' || o_orderstatus as folder from orders where o_orderstatus <> 'P'")
def read_by_pattern_query(s: Standins):
    """Files below a folder whose names match a pattern."""
    path = _folder(s, "patterns")
    for status in ("F", "O", "P"):
        lot = s.raw("orders").filter(F.col("o_orderstatus") == status).select(F.col("o_orderkey").cast("string"))
        (lot.write.option("compression", "gzip" if status == "P" else "none").text(f"{path}/order-{status}"))
    found = read_by_pattern(s.spark, path, "*.txt", recursive=True)
    return found.select(F.regexp_extract("path", "/(order-[A-Z])/", 1).alias("folder")).distinct()


@query("period_from_name", """
    select o_orderkey, case when o_orderstatus = 'O' then cast(o_orderdate as date) end as period_begin,
           cast(o_orderdate as date) + 30 as period_end from orders""")
def period_from_name(s: Standins):
    first, last = F.col("o_orderdate").cast("date"), F.date_add(F.col("o_orderdate").cast("date"), 30)
    begin = F.when(F.col("o_orderstatus") == "O", F.concat(F.date_format(first, "d-M-yyyy"), F.lit("_"))).otherwise("")
    name = F.concat(F.lit("ReviewOf_"), begin, F.date_format(last, "d-M-yyyy"), F.lit(".dat"))
    period = feeds.period_of(name)
    return s.raw("orders").select(
        "o_orderkey", period["begin"].alias("period_begin"), period["end"].alias("period_end")
    )


@query("parse_listing", """
    select cast(p_partkey as varchar) as book_uid, p_name as title, cast(p_size - 1 as int) as nb_reviews,
           p_type as author_fname, p_brand as author_lname from part where p_size > 2""")
def parse_listing(s: Standins):
    book = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("titre"),
        F.col("p_size").cast("string").alias("nbrcrit"),
        F.concat_ws(", ", "p_brand", "p_type").alias("auteurstring"),
    )
    reply = F.to_json(F.struct(F.lit("9").alias("total"), F.array(book).alias("data"), F.lit(0).alias("success")))
    payloads = s.raw("part").select(F.concat(F.lit("("), reply, F.lit(")\n")).alias("value"))
    return feeds.parse_listing(payloads)


@query("replace_site_partition", """
    select work_refid, site_logical_name, rating_n, parsed_review_date from staged_reviews
    where site_logical_name <> 'ASIA' or l_shipdate >= timestamp '1998-01-01'""")
def replace_site_partition(s: Standins):
    """All sites are staged, then one site is staged anew; the others stay."""
    columns = ["work_refid", "site_logical_name", "rating_n", "parsed_review_date"]
    staged = s.staged_reviews()
    store = Store(s.spark, _folder(s, "staging"))
    store.replace_partition("review", staged.select(*columns), "site_logical_name")
    later = staged.filter(
        (F.col("site_logical_name") == "ASIA") & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    )
    store.replace_partition("review", later.select(*columns), "site_logical_name")
    return store.read("review").select(*columns)


@query("truncate_and_load", "select o_orderkey, o_custkey from orders where o_orderstatus = 'F'")
def truncate_and_load(s: Standins):
    orders = s.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    store = Store(s.spark, _folder(s, "staging"))
    store.truncate_and_load("work_info", orders)
    store.truncate_and_load("work_info", store.read("work_info").filter(F.col("o_orderstatus") == "F"))
    return store.read("work_info").select("o_orderkey", "o_custkey")


@query("append_batch", """
    select work_refid, user_id, parsed_rating, load_audit_id from review_r where load_audit_id <> 1996""")
def append_batch(s: Standins):
    """Every year is one load; one is repeated (and replaces itself), one is taken back."""
    rows = s.review_r(with_user=False).select("work_refid", "user_id", "parsed_rating", "load_audit_id")
    store = Store(s.spark, _folder(s, "integration"))
    store.append_batch("review", rows)
    store.append_batch("review", rows.filter(F.col("load_audit_id") == 1998))
    store.drop_batch("review", 1996)
    return store.read("review").select("work_refid", "user_id", "parsed_rating", "load_audit_id")


@query("ledger_latest", """
    select 'user ' || user_id as batch_job, event_type as step_name,
           max_by(case when value > 20 then 'Completed' else 'Failed' end, ts) as status, max(ts) as run_dts,
           max_by(cast(round(value) as bigint), ts) as rows_impacted
    from events group by user_id, event_type""")
def ledger_latest(s: Standins):
    entries = s.raw("events").select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("batch_job"),
        F.col("event_type").alias("step_name"),
        F.when(F.col("value") > 20, ledger.COMPLETED).otherwise(ledger.FAILED).alias("status"),
        F.col("ts").alias("run_dts"),
        F.round("value").cast("long").alias("rows_impacted"),
    )
    return ledger.ledger_latest(entries)


@query("ingest_dumps", """
    select event_type, count(*) as nb, min(event_id) as first_id from events group by 1""")
def ingest_dumps(s: Standins):
    """Files arriving in two lots are each taken once."""
    folder, checkpoint = _folder(s, "incoming"), _folder(s, "ingest")
    store = Store(s.spark, _folder(s, "staging"))
    steps = ledger.Ledger(s.spark, _folder(s, "load_audit"))
    now = datetime.fromisoformat(NOW)
    events = s.raw("events").select("event_id", "event_type", "ts")
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    for lot in (events.filter(F.col("ts") < split), events.filter(F.col("ts") >= split)):
        lot.select("event_id", "event_type").write.mode("append").csv(folder, sep="|", header=True)
        ingest.ingest_dumps(
            s.spark, folder, ("event_id", "event_type"), checkpoint,
            ingest.into_store(store, "events", steps, "ingest", now),
        )
    return store.read("events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("nb"), F.min(F.col("event_id").cast("long")).alias("first_id")
    )


@query("ingest_reviews", """
    with r as (select site_logical_name as site, user_uid, work_refid, parsed_review_date as day, title,
                      site_logical_name in ('AFRICA', 'ASIA') as early from staged_reviews),
    mark as (select max(day) - 30 as first_day from r where early and day < date '2001-01-01'),
    once as (select distinct site, user_uid, work_refid, day, title,
                    case when early then case when day >= date '2001-01-01' then 1 else 0 end
                         when day < first_day then -1 when day >= date '2001-01-01' then 1 else 0 end as period_class
             from r, mark)
    select site, cast(period_class as int) as period_class, count(*) as nb from once group by all""")
def ingest_reviews(s: Standins):
    """Two lots of files and the first one sent again, harvested at the end of 2000: each review once, others beside."""
    folder, checkpoint, store = _folder(s, "incoming"), _folder(s, "ingest"), Store(s.spark, _folder(s, "staging"))
    intake = reviews.ReviewIntake(
        store, "review", ledger.Ledger(s.spark, _folder(s, "load_audit")), "intake", datetime(2000, 12, 31))
    # Read by three lots: the joins are made once. Dumps of this size come compressed.
    staged = materialize(s.staged_reviews().select(
        "site_logical_name", "user_uid", "work_refid", "parsed_review_date", F.col("title").alias("review")), "staged")
    early = F.col("site_logical_name").isin("AFRICA", "ASIA")
    for lot in (staged.filter(early), staged.filter(~early), staged.filter(early)):
        lot.write.mode("append").csv(folder, sep="|", header=True, quote='"', escape='"', compression="gzip")
        ingest.ingest_dumps(s.spark, folder, reviews.KEY, checkpoint, intake.sink())
    on_time = store.read("review").withColumn("period_class", F.lit(0))
    both = on_time.unionByName(store.read("review_late"))
    return both.groupBy(F.col("site_logical_name").alias("site"), "period_class").agg(F.count(F.lit(1)).alias("nb"))


# -- pages -------------------------------------------------------------------------------


def _escaped(c: Column | str) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def _pages(s: Standins) -> DataFrame:
    """A page of each text in the markup of its site."""
    reviews = s.review_t().select(
        "id", "site_id", "user_id", "review", "review_date",
        (F.col("text_length") % 10 + 1).cast("int").alias("parsed_rating"),
        (F.col("text_length") % 7).cast("int").alias("parsed_likes"),
    )
    raw = reviews.select(
        "*", raw_rating().alias("rating"), raw_date().alias("dated"), raw_likes().alias("likes"),
        raw_link().alias("link"), _escaped(F.col("review")).alias("body"),
        F.concat(F.lit("name "), F.col("user_id").cast("string")).alias("name"), site_name("site_id").alias("site"),
    )
    stars = F.array_join(F.array_repeat(F.lit('<span class="staticStar p10"></span>'), (F.col("parsed_rating") % 6)), "")
    likes = F.coalesce(F.col("likes"), F.lit(""))
    ident = F.col("id").cast("string")
    html = (
        F.when(F.col("site_id") == 1, F.concat(
            F.lit('<html><div class="tags"><span><a href="/t">Tag A</a><span class="count"> (3)</span></span></div>'
                  '<div class="bookReview"><div class="commentText">'), "body",
            F.lit('<span class="rating"><img src="http://pics.example/pics/'), "rating",
            F.lit('"></span></div><div class="commentFooter"><span class="reviewVoteCount">'), likes,
            F.lit('</span><span class="controlItems"><a href="'), "link", F.lit('">x</a> | '), "dated",
            F.lit(' |  <a href="/review/1">p</a></span></div></div></html>')))
        .when(F.col("site_id") == 2, F.concat(
            F.lit('<div class="elementList "><div class="left"><a>Cities</a> &gt; <a>Plans</a></div>'
                  '<div class="right"><a>512 users</a></div></div><div id="review_1">'
                  '<a itemprop="publishDate">'), "dated", F.lit("</a>"), stars,
            F.lit('<a class="user" title="'), "name", F.lit('" href="'), "link", F.lit('">n</a>'
                  '<span id="reviewTextContainer1"><span id="freeTextContainer1">short</span><span id="freeText1">'), "body",
            F.lit("</span></span>"),
            F.when(F.col("likes").isNotNull(), F.concat(F.lit('<span class="likesCount">'), "likes", F.lit("</span>"))).otherwise(""),
            F.lit("</div>")))
        .when(F.col("site_id") == 3, F.concat(
            F.lit('<table width="100%" border="0" cellspacing="0" cellpadding="3"><tr><td class="titre">t</td>'
                  '<td class="texte"><img name="'), "rating", F.lit('"></td></tr><tr><td class="texte"><p>'), "body",
            F.lit('</p><p><a href="'), "link", F.lit('">'), "name", F.lit("</a>"), "dated",
            F.lit("</p></td></tr><tr><td><hr></td></tr></table>")))
        .when(F.col("site_id") == 4, F.concat(
            F.lit('<p class="tags"><a rel="tag" class="tag_t23 tc0 ">roman</a></p><div class="post_con"><a class="author" href="'),
            "link", F.lit('">'), "name", F.lit('</a><table><tr><td class="no_img"><span>'), "dated",
            F.lit("</span></td></tr></table>"),
            F.when(F.col("rating").isNotNull(), F.concat(F.lit('<li class="current-rating">'), "rating", F.lit("</li>"))).otherwise(""),
            F.lit('<div class="text row"><div>'), "body",
            F.lit('</div></div><span class="post_items_like "><span id="l1">'), likes, F.lit("</span></span></div>")))
        .otherwise(F.concat(
            F.lit('<div class="a-section review"><span class="a-icon-alt">'), "rating",
            F.lit('</span><a class="a-size-base a-link-normal author" href="'), "link", F.lit('">'), "name",
            F.lit('</a><span class="a-size-base a-color-secondary review-date">'), "dated",
            F.lit('</span><span class="cr-vote-buttons"><span class="a-color-secondary">'
                  '<span class="a-size-small a-color-secondary review-votes">'), likes,
            F.lit('</span></span></span><span class="a-size-base review-text">'), "body", F.lit("</span></div>")))
    )
    domain = F.when(F.col("site") == fields.AMAZON, F.col("site")).otherwise(F.concat(F.col("site"), F.lit(".com")))
    route = F.when(F.col("site_id") == 1, "/work/").when(F.col("site_id") == 2, "/book/show/").when(
        F.col("site_id") == 3, "/i.php/vcrit/").when(F.col("site_id") == 4, "/livres/").otherwise("/product-reviews/")
    tail = F.when(F.col("site_id") == 5, "/ref=cm").otherwise("")
    url = F.concat(F.lit("https://www."), domain, route, ident, tail)
    given = s.raw("pages").select("url", "html")
    return raw.select(url.alias("url"), html.alias("html")).union(given)


@query("extract_reviews_from_pages", f"""
    with r as (select id, site_id, user_id, {SITE_SQL} as site, review, review_date,
                      cast(text_length % 10 + 1 as int) as n, cast(text_length % 7 as int) as k from review_t)
    select cast(id as varchar) as work_uid, site as site_logical_name,
           regexp_replace(review, '^\\s+|\\s+$', '', 'g') as review,
           cast(case site_id when 1 then n when 2 then case when n % 6 > 0 then 2 * (n % 6) end when 3 then n
                when 4 then 2 * (n % 6) else 2 * (n % 6) + 1 end as int) as parsed_rating,
           case when site_id = 1 and day(review_date) = 1 then null else review_date end as parsed_review_date,
           cast(case when site_id in (1, 2, 5) and k = 0 then null when site_id = 3 then null else k end as int) as parsed_likes,
           case site_id when 1 then 'user' || user_id when 2 then user_id || '-some-name' when 3 then 'a' || user_id
                when 4 then cast(user_id as varchar) else 'A' || user_id end as user_uid,
           case when site_id = 1 then 'user' || user_id else 'name ' || user_id end as username,
           case site_id when 1 then 'Tag A' when 2 then 'Cities > Plans' when 4 then 'roman' end as tags_t,
           case site_id when 1 then '3' when 2 then '512 ' when 4 then '23' end as tags_n
    from r""")
def extract_reviews_from_pages(s: Standins):
    stored = materialize(_pages(s), "pages")
    return pages.extract_reviews(stored).select(
        "work_uid", "site_logical_name", "review", "parsed_rating", "parsed_review_date", "parsed_likes",
        "user_uid", "username", "tags_t", "tags_n",
    )


@query("extract_work_details", """
    select p_partkey as work_refid, case when p_type = 'PROMO' then p_partkey + 1000000 end as dup_refid,
           p_name as title, 'English' as original_lang, p_brand || ';' || p_type as authors,
           lower(p_type) || 'x;' || lower(p_type) || 'y' as authors_code,
           substr(digits, 1, 3) || '.' || substr(digits, 4) as mds_code, 'Literature-->' || p_type as mds_text,
           substr(digits, 1, 2) as mds_code_corr, 'Love->' || p_type || '__&__Other' as lc_subjects,
           case when p_size < 25 then null else p_size || ',109' end as popularity,
           'French : ' || p_name || '__&__German : ' || p_name as other_lang_title
    from part_code""")
def extract_work_details(s: Standins):
    code = F.col("digits")
    dotted = F.concat(F.substring(code, 1, 3), F.lit("."), F.substr(code, F.lit(4)))
    popular = F.when(F.col("p_size") < 25, F.lit("—")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(",109")))
    html = F.concat(
        F.lit('<div class="headsummary"><h2><a href="/author/'), F.lower("p_type"), F.lit('x">'), "p_brand",
        F.lit('</a> <a href="/author/'), F.lower("p_type"), F.lit('y">'), "p_type", F.lit("</a></h2></div>"
              '<table id="book_bookInformationTable"><tr><td>Title</td><td><b>'), "p_name",
        F.lit('</b></td></tr><tr><td>Lang</td><td><a href="/language.php?l=eng">English</a></td></tr>'
              "<tr><td>Other language titles</td><td>French : "), "p_name", F.lit("<br>German : "), "p_name",
        F.lit('</td></tr><tr><td><div id="ddcdisplay"><p><a>'), dotted,
        F.lit("</a><a>Literature</a><a>not-set</a><a>"), "p_type",
        F.lit('</a></p></div><div class="subjectLine"><a href="/subject/1">Love</a> &gt; <a href="/subject/2">'), "p_type",
        F.lit('</a></div><div class="subjectLine"><a href="/subject/3">Other</a></div></td></tr></table>'
              '<table><tr class="wslcontent"><td>1</td><td>2</td><td><a href="/popularity">'), popular,
        F.lit("</a></td></tr></table>"),
    )
    asked = F.when(F.col("p_type") == "PROMO", F.col("p_partkey") + 1000000).otherwise(F.col("p_partkey"))
    made = s._part_code().select(
        asked.alias("requested_refid"),
        F.concat(F.lit("https://www.librarything.com/work/"), F.col("p_partkey").cast("string"), F.lit("/workdetails")).alias("url"),
        html.alias("html"),
    )
    return pages.extract_work_details(materialize(made, "pages"))
