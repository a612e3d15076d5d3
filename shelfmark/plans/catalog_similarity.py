"""Registered near-duplicate queries and the reports on their result."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from shelfmark.functions.text import jaccard, trigrams
from shelfmark.operators import sameuser, similarity as sim
from shelfmark.plans import reports
from shelfmark.plans.catalog_reports import SITES
from shelfmark.plans.grams import GRAMS_SQL
from shelfmark.plans.registry import query
from shelfmark.plans.standins import NOW, Standins
from shelfmark.plans.tables import layout
from shelfmark.sources.tables import materialize, shuffle_files_dropped, spread

_PAIRS = f"""grams as (select *, {GRAMS_SQL} as g from review_t),
    pairs as (select r.id, o.id as other_id, r.site_id, o.site_id as other_site_id, r.review_date,
            len(list_intersect(r.g, o.g))::double
              / (len(r.g) + len(o.g) - len(list_intersect(r.g, o.g))) as similarity
        from grams r join grams o on r.work_refid = o.work_refid and r.review_lang = o.review_lang
             and r.id > o.id and r.text_length between o.text_length - round(o.text_length * 0.08)
                                                   and o.text_length + round(o.text_length * 0.08)
        where r.text_length >= 100 and o.text_length >= 100),
    similarto as (select site_id, p.id as review_id, other_site_id, p.other_id as other_review_id,
            round(similarity, 6) as similarity, review_date
        from pairs p join (select id, min(other_id) as o_id from pairs where similarity >= 0.6 group by 1) t
             on t.id = p.id and t.o_id = p.other_id)"""


def _queue(s: Standins) -> DataFrame:
    return s.review_t().select(
        "work_refid",
        F.col("id").alias("review_id"),
        F.length("review").alias("text_length"),
        "review_lang",
        F.lit(None).cast("timestamp_ntz").alias("date_processed"),
    )


def _similar(s: Standins) -> DataFrame:
    return sim.pick_similar(_queue(s), s.review_t())


@query("enqueue_similarity", """
    with fresh as (select distinct refid from work w where last_harvest_dts is not null
        and refid in (select work_refid from work_site_mapping where site_id = 2)
        and refid in (select work_refid from work_site_mapping where site_id = 4)
        and refid not in (select work_refid from review_t where review_lang = 'fr')
        order by 1 limit 40)
    select fresh.refid as work_refid, coalesce(r.id, -1) as review_id,
           cast(coalesce(length(r.review), 0) as int) as text_length, r.review_lang
    from fresh left join review_t r on r.work_refid = fresh.refid""")
def enqueue_similarity(s: Standins):
    queued = s.review_t().filter(F.col("review_lang") == "fr")
    return sim.enqueue_similarity(s.work(), s.work_site_mapping(), queued, s.review_t(), n=40)


@query("trigram_similarity", f"""
    with grams as (select *, {GRAMS_SQL} as g from review_t),
    firsts as (select work_refid, review_lang, min(id) as first_id from review_t group by 1, 2)
    select r.id, f.first_id, round(len(list_intersect(r.g, o.g))::double
           / (len(r.g) + len(o.g) - len(list_intersect(r.g, o.g))), 6) as similarity
    from grams r join firsts f on f.work_refid = r.work_refid and f.review_lang = r.review_lang
    join grams o on o.id = f.first_id""")
def trigram_similarity(s: Standins):
    """Each review against the first one of its work and language."""
    # A small scan is few splits, and the sets are the work: the texts are spread first.
    rows = spread(s.review_t().select("id", "work_refid", "review_lang", "review"), "id")
    reviews = rows.select(
        "id", "work_refid", "review_lang", trigrams("review").alias("grams")
    ).withColumn("n", F.size("grams"))
    # The first reviews are picked before any set of theirs is built.
    firsts = s.review_t().groupBy("work_refid", "review_lang").agg(F.min("id").alias("first_id"))
    texts = s.review_t().select(F.col("id").alias("first_id"), F.col("review").alias("first_review"))
    sets = (
        spread(firsts.join(texts, "first_id"), "first_id")
        .withColumn("first_grams", trigrams("first_review"))
        .withColumn("first_n", F.size("first_grams"))
        .drop("first_review")
    )
    return reviews.join(sets, ["work_refid", "review_lang"]).select(
        "id", "first_id", F.round(jaccard("grams", "first_grams", "n", "first_n"), 6).alias("similarity")
    )


@query("pick_similar", f"""
    with {_PAIRS} select site_id, review_id, other_site_id, other_review_id, similarity from similarto""")
def pick_similar(s: Standins):
    return _similar(s).withColumn("similarity", F.round("similarity", 6))


@query("pick_similar_pending", f"""
    with {_PAIRS} select site_id, review_id, other_site_id, other_review_id, similarity from similarto
    where review_date >= date '2020-01-04'""")
def pick_similar_pending(s: Standins):
    """A later batch: older reviews were processed before and only serve as partners."""
    dates = s.review_t().select(F.col("id").alias("review_id"), "review_date")
    queue = (
        _queue(s).drop("date_processed").join(dates, "review_id")
        .withColumn(
            "date_processed",
            F.when(F.col("review_date") < F.lit("2020-01-04").cast("date"), F.lit(NOW).cast("timestamp_ntz")),
        )
    )
    return sim.pick_similar(queue, s.review_t()).withColumn("similarity", F.round("similarity", 6))


def _batch(s: Standins, first: bool) -> DataFrame:
    """The queue while the first or the second of two batches is processed."""
    dates = s.review_t().select(F.col("id").alias("review_id"), "review_date")
    queue, early = _queue(s).drop("date_processed").join(dates, "review_id"), F.col("review_date") < F.lit("2020-01-04").cast("date")
    if first:
        return queue.filter(early).withColumn("date_processed", F.lit(None).cast("timestamp_ntz"))
    return queue.withColumn("date_processed", F.when(early, F.lit(NOW).cast("timestamp_ntz")))


@query("pick_similar_indexed", f"""
    with {_PAIRS} select site_id, review_id, other_site_id, other_review_id, similarity from similarto
    where review_date >= date '2020-01-04'""")
def pick_similar_indexed(s: Standins):
    """The second of two batches out of a kept index, which both have added to."""
    members = s.spark.createDataFrame([], layout("similar_member")).drop("load_audit_id")
    classes = s.spark.createDataFrame([], layout("similar_class")).drop("load_audit_id")
    queue = None
    for first in (True, False):
        # Once a lot is written, nothing reads its shuffle files again.
        with shuffle_files_dropped(s.spark):
            queue = materialize(_batch(s, first), "queue")
            added = materialize(sim.by_work(sim.index_members(queue, s.review_t(), members)), "member-lot")
            texts = materialize(sim.by_work(sim.index_classes(added, s.review_t(), classes)), "class-lot")
        members, classes = members.unionByName(added), classes.unionByName(texts)
    return sim.pick_indexed(queue, members, classes).withColumn("similarity", F.round("similarity", 6))


# Four readers on each of three sites; a work is read on all of them.
_SAME = f"""{_PAIRS},
    who as (select id, site_id, site_id * 10 + (work_refid + id // 60) % 4 as reader
            from (select id, work_refid, id // 20 % 3 + 1 as site_id from review_t)),
    sides as (select mine.reader as a, mine.site_id as sa, mine.id as ia, theirs.reader as b, theirs.site_id as sb, theirs.id as ib
              from similarto join who mine on mine.id = review_id join who theirs on theirs.id = other_review_id
              where mine.site_id <> theirs.site_id),
    agreed as (select a, sa, b, sb, least(count(distinct ia), count(distinct ib)) as texts
               from (from sides union all select b, sb, ib, a, sa, ia from sides) group by all having texts >= 2),
    best as (select a, sa, b, sb from agreed qualify row_number() over (partition by a, sb order by texts desc, b) = 1),
    up as (select a, arg_min(b, sb) as b from best where sb < sa and (b, a) in (select (a, b) from best) group by a),
    climb(a, b, steps) as (select a, b, 1 from up union all select climb.a, up.b, steps + 1 from climb join up on up.a = climb.b),
    same as (select a as user_id, arg_max(b, steps) as same_user_id from climb group by a)"""


def _same_users(s: Standins) -> tuple[DataFrame, DataFrame]:
    """Reviews with a reader of their site, and the readers found to be the same."""
    part = lambda n: F.floor(F.col("id") / n)
    reviews = s.review_t().withColumn("site_id", part(20) % 3 + 1).withColumn(
        "user_id", F.col("site_id") * 10 + (F.col("work_refid") + part(60)) % 4)
    return reviews, sameuser.same_users(_similar(s), reviews)


@query("same_user", f"""
    with recursive {_SAME}
    from same union select same_user_id, same_user_id from same""")
def same_user(s: Standins):
    return _same_users(s)[1]


@query("user_book_matrix_same_users", f"""
    with recursive {_SAME},
    keys as (select work_refid, title || '::' || string_agg(name, '_' order by name) as book_key
             from work_author join author using (author_id) join work_info using (work_refid) group by work_refid, title)
    select coalesce(same_user_id, who.reader) as user_key, book_key, round(avg(text_length % 10), 6) as rating
    from review_t join who using (id) left join same on same.user_id = who.reader join keys using (work_refid)
    group by 1, work_refid, book_key""")
def user_book_matrix_same_users(s: Standins):
    """The reviewer matrix with the users found to be the same merged."""
    reviews, same = _same_users(s)
    rated = reviews.withColumn("parsed_rating", F.col("text_length") % 10)
    return reports.user_book_matrix(rated, s.work_info(), s.work_author(), s.author(), same)


@query("similarity_groups", f"""
    with recursive {_PAIRS},
    edges as (select review_id as a, other_review_id as b from similarto
              union select other_review_id, review_id from similarto),
    reach(node, root) as (select a, a from edges union select edges.b, reach.root from reach join edges on edges.a = reach.node)
    select node as review_id, min(root) as group_id from reach group by node""")
def similarity_groups(s: Standins):
    return sim.similarity_groups(_similar(s))


@query("mark_processed", f"""
    select work_refid, id as review_id, case when review_date < date '2020-01-04'
           then timestamp '2015-01-01' else timestamp '{NOW}' end as date_processed from review_t""")
def mark_processed(s: Standins):
    old = F.lit("2015-01-01").cast("timestamp_ntz")
    queue = s.review_t().select(
        "work_refid",
        F.col("id").alias("review_id"),
        F.when(F.col("review_date") < F.lit("2020-01-04").cast("date"), old).alias("date_processed"),
    )
    return sim.mark_processed(queue, NOW)


@query("duplicate_ratio", f"""
    with {_PAIRS},
    paired as (select distinct unnest([review_id, other_review_id]) as id from similarto),
    sizes as (select (select count(*) from review_t where id in (from paired)) as copies,
                     (select count(*) from review_t) as reviews,
                     (select count(*) from (select distinct work_refid from review_t)) as works)
    select copies, reviews, round(reviews / works, 6) as reviews_per_work, round(copies / works, 6) as copies_per_work,
           round(copies / reviews, 6) as copy_share from sizes""")
def duplicate_ratio(s: Standins):
    return reports.duplicate_ratio(s.review_t(), _similar(s))


# What both reviews of a pair have in common: reader, day, site.
SHARED = {
    "same_in_all": (True, True, True), "other_reader": (False, True, True), "other_day": (True, False, True),
    "other_site": (True, True, False), "same_reader_only": (True, False, False), "same_day_only": (False, True, False),
    "same_in_none": (False, False, False),
}


def _matrix_sql() -> str:
    """Pairs described once by their two sites and three flags, then counted by description."""
    places = [(f"inside_{n}", i, i) for n, i in SITES.items()] + [
        (f"across_{a}_{b}", min(i, j), max(i, j)) for (a, i), (b, j) in combinations(SITES.items(), 2)]
    counts = [f"count(*) filter (low = {low} and high = {high}) as {name}" for name, low, high in places]
    counts += [
        "count(*) filter (" + " and ".join(f if is_so else f"not {f}" for f, is_so in zip(("reader", "day", "site"), flags, strict=True))
        + f") as {name}" for name, flags in SHARED.items()]
    return f"""
    with {_PAIRS},
    described as (select review_t.id, review_t.site_id as place, review_date as written, username as name
                  from review_t join users on users.id = user_id),
    flagged as (select least(mine.place, theirs.place) as low, greatest(mine.place, theirs.place) as high,
                       mine.name = theirs.name as reader, mine.written = theirs.written as day,
                       mine.place = theirs.place as site
                from similarto join described mine on mine.id = review_id join described theirs on theirs.id = other_review_id)
    select {', '.join(counts)} from flagged"""


@query("duplicate_matrix", _matrix_sql())
def duplicate_matrix(s: Standins):
    return reports.duplicate_matrix(_similar(s), s.review_t(), s.users(), SITES, SHARED)
