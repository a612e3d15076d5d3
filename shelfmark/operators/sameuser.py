"""Users of several sites who are the same person, by the texts they share.

Evidence for two users of different sites is the number of texts they agree on: similar
pairs between them, where a review counts once however many it resembles. A user's best
partner on another site is the one with the most such texts, of several the lowest id. Two
users are linked only if each is the other's best and enough texts agree, so a text that
many people copied links nobody by itself. A linked user belongs to the partner on the
lowest site, who may belong to one on a lower site still; the last one stands for all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.sources.tables import materialize, shuffle_files_dropped

LEAST_TEXTS = 2


def shared_texts(similar: DataFrame, reviews: DataFrame) -> DataFrame:
    """user, site, other, other_site and texts of users who agree on texts between sites, in both directions.

    Pairs are reduced to users after two lookups that are unique on the review, so a text
    with very many copies is as many rows as it has copies, never their pairs.
    """
    who = reviews.select("id", "user_id", "site_id")

    def side(column: str, prefix: str) -> DataFrame:
        return who.select(
            F.col("id").alias(column), F.col("user_id").alias(f"{prefix}user"), F.col("site_id").alias(f"{prefix}site"))

    pairs = (
        similar.select("review_id", "other_review_id")
        .join(side("review_id", ""), "review_id")
        .join(side("other_review_id", "o_"), "other_review_id")
        .filter(F.col("site") != F.col("o_site"))
    )
    # A pair stands under its later review; both orders of two users are one evidence.
    def way(review: str, user: str, site: str, other_review: str, other: str, other_site: str):
        return F.struct(
            F.col(review).alias("review_id"), F.col(user).alias("user"), F.col(site).alias("site"),
            F.col(other_review).alias("other_review_id"), F.col(other).alias("other"), F.col(other_site).alias("other_site"))

    there = ("review_id", "user", "site", "other_review_id", "o_user", "o_site")
    return pairs.select(F.explode(F.array(way(*there), way(*there[3:], *there[:3]))).alias("way")).select("way.*").groupBy(
        "user", "site", "other", "other_site"
    ).agg(F.least(F.count_distinct("review_id"), F.count_distinct("other_review_id")).alias("texts"))


def mutual_best(evidence: DataFrame) -> DataFrame:
    """user, site, other, other_site of users who are each other's best, in both directions."""
    best = (
        evidence.groupBy("user", "site", "other_site")
        .agg(F.min(F.struct((-F.col("texts")).alias("less"), "other")).alias("best"))
        .select("user", "site", "other_site", F.col("best.other").alias("other"))
    )
    back = best.select(F.col("user").alias("other"), F.col("other").alias("user"))
    return best.join(back, ["user", "other"], "left_semi")


def same_users(similar: DataFrame, reviews: DataFrame, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """user_id and same_user_id, the representative, of every linked user; it stands for itself too.

    ``similar``: review_id, other_review_id; ``reviews``: id, user_id, site_id. A user id
    belongs to one site. Pairs whose reviews have no user or site give no evidence.
    """
    # Pairs are found once; what follows reads the few users who agree.
    with shuffle_files_dropped(reviews.sparkSession):
        agreed = materialize(shared_texts(similar, reviews).filter(F.col("texts") >= least_texts), "agreed")
    links = mutual_best(agreed)
    up = (
        links.filter("other_site < site").groupBy("user")
        .agg(F.min(F.struct("other_site", "other")).alias("to"), F.min("site").alias("site"))
        .select("user", "site", F.col("to.other").alias("top"))
    )
    # A step up leads to a lower site: doubling the steps ends within the number of sites.
    n_sites = up.agg(F.count_distinct("site")).first()[0]
    for _ in range(n_sites.bit_length()):
        above = up.select(F.col("user").alias("top"), F.col("top").alias("next"))
        up = up.join(above, "top", "left").select("user", "site", F.coalesce("next", "top").alias("top"))
    members = up.select(F.col("user").alias("user_id"), F.col("top").alias("same_user_id"))
    tops = members.select(F.col("same_user_id").alias("user_id"), "same_user_id").distinct()
    return members.union(tops)
