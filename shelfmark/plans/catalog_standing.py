"""Registered reports over states kept per load, and reviews with patches laid over them.

Each year's reviews are a load; one load is repeated, and one is taken back. The SQL reads
the reviews that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.operators import overlay, repair, standing
from shelfmark.plans.catalog_sources import _folder
from shelfmark.plans.registry import query
from shelfmark.plans.standins import Standins
from shelfmark.sources.tables import Store

SITES = {"lt": 1, "gr": 2, "ba": 4}
_LEFT = "(from review_r where load_audit_id <> 1996)"


def _store(s: Standins) -> Store:
    """States of all loads, the load of 1998 written twice and that of 1996 taken back."""
    store, reviews = Store(s.spark, _folder(s, "states")), s.review_r()
    for rows in (reviews, reviews.filter(F.col("load_audit_id") == 1998)):
        store.append_batch("review_state", standing.load_state(rows))
        store.append_batch("review_readers", standing.load_readers(rows))
    for name in ("review_state", "review_readers"):
        store.drop_batch(name, 1996)
    return store


@query("standing_site_counts", f"select site_id, count(*) as nb_reviews from {_LEFT} group by site_id")
def standing_site_counts(s: Standins) -> DataFrame:
    return standing.reviews_by_site(_store(s).read("review_state"))


@query("standing_top_books", f"""
    with counts as (select work_refid, count(*) as nb_reviews from {_LEFT} group by work_refid)
    select title || ' (id=' || work_refid || ')' as book, nb_reviews from counts join work_info using (work_refid)
    order by nb_reviews desc, book limit 20""")
def standing_top_books(s: Standins) -> DataFrame:
    return standing.top_books(_store(s).read("review_state"), s.work_info())


def _comparison_sql() -> str:
    names = list(SITES)
    per_work = ", ".join(
        f"avg(parsed_rating) filter (site_id = {i}) as m_{n}, stddev_samp(parsed_rating) filter (site_id = {i}) as d_{n}"
        for n, i in SITES.items())
    out = [f"round(avg(m_{n}), 6) as mean_{n}, round(avg(d_{n}), 6) as std_{n}" for n in names]
    out += [f"round(avg(m_{a} - m_{b}), 6) as mean_{a}_{b}, round(avg(d_{a} - d_{b}), 6) as std_{a}_{b}, "
            f"round(corr(m_{a}, m_{b}), 6) as corr_{a}_{b}" for i, a in enumerate(names) for b in names[i + 1:]]
    return f"with works as (select work_refid, {per_work} from {_LEFT} group by work_refid) select {', '.join(out)} from works"


@query("standing_site_comparison", _comparison_sql())
def standing_site_comparison(s: Standins) -> DataFrame:
    return standing.site_rating_comparison(_store(s).read("review_state"), SITES)


@query("standing_reviews_per_site", f"""
    select site_id, round(count(*) / count(distinct work_refid), 6) as avg_reviews_per_book, true as reviewers_within_error
    from {_LEFT} group by site_id""")
def standing_reviews_per_site(s: Standins) -> DataFrame:
    """Reviews per book are exact; the number of reviewers is held against the exact one."""
    store = _store(s)
    found = standing.reviews_per_site(store.read("review_state"), store.read("review_readers"))
    exact = s.review_r().filter(F.col("load_audit_id") != 1996).groupBy("site_id").agg(
        F.count_distinct("user_id").alias("exact"))
    off = F.abs(F.col("nb_reviewers") - F.col("exact")) / F.col("exact")
    return found.join(exact, "site_id").select(
        "site_id", "avg_reviews_per_book", (off <= standing.SKETCH_ERROR).alias("reviewers_within_error"))


# Long texts get another language, very short ones go, then texts in capitals lose theirs.
_PATCHED = """
    select id, site_id, review, case
             when length(review) >= 30 and regexp_matches(review, '[A-Z]')
                  and length(regexp_replace(review, '[A-Z]', '', 'g')) / length(review) < 0.5 then null
             when length(review) > 2000 then 'xx' else review_lang end as review_lang
    from review_t where length(review) >= 25"""


@query("overlay_reviews", _PATCHED)
def overlay_reviews(s: Standins) -> DataFrame:
    """Four loads of patches, the last of them undone, laid over reviews that stay as they are."""
    store = Store(s.spark, _folder(s, "patches"))
    reviews = s.review_t().select("id", "site_id", "review", "review_lang")
    store.append_batch("patch", overlay.value_patch(reviews.filter(F.length("review") > 2000), "review_lang", F.lit("xx"), 1))
    store.append_batch("patch", overlay.deletion_patch(reviews.filter(F.length("review") < 25), 2))
    store.append_batch("patch", overlay.value_patch(repair.lang_resets(reviews), "review_lang", F.lit(None), 3))
    store.append_batch("patch", overlay.deletion_patch(reviews.filter("site_id = 5"), 4))
    store.drop_batch("patch", 4)
    return overlay.laid_over(reviews, s.spark.read.schema(overlay.PATCH).parquet(store.path("patch")), ("review_lang",))
