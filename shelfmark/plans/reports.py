"""Analytic reports.

Integration reports read ``review_r``-shaped facts (work_refid, user_id, site_id,
review_date, parsed_rating, parsed_likes, review_lang); star reports read the
presentation names (book_id, reviewer_id, site_id, date_id, rating, nb_likes,
lang_code). Facts are reduced to (sum, count) on the join key before they meet a
dimension, so a book or site that holds a large share of the facts is combined on the
map side and no join carries the raw rows of a hot key. Averages are sums over counts
of ratings that are not NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _avg(total: str = "rating_sum", n: str = "rating_n") -> Column:
    return F.round(F.col(total) / F.col(n), 6)


def _reduce(facts: DataFrame, keys: Sequence[str | Column], rating: str) -> DataFrame:
    return facts.groupBy(*keys).agg(
        F.sum(rating).alias("rating_sum"),
        F.count(rating).alias("rating_n"),
        F.count(F.lit(1)).alias("row_n"),
    )


def _total(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("rating_sum").alias("rating_sum"),
        F.sum("rating_n").alias("rating_n"),
        F.sum("row_n").alias("row_n"),
    )


def _weighted(over: str) -> Column:
    """Group averages weighted by row counts, over one title."""
    w = Window.partitionBy(over)
    weighted = F.sum(F.col("rating_sum") / F.col("rating_n") * F.col("row_n")).over(w)
    return F.round(weighted / F.sum("row_n").over(w), 6)


# -- rating over time ------------------------------------------------------------


def _trend(facts: DataFrame, books: DataFrame, key: str, title: str, date: str, rating: str) -> DataFrame:
    per_book = _reduce(facts, [key, F.trunc(date, "year").alias("year")], rating)
    per_title = _total(per_book.join(books.select(key, title), key), [title, "year"])
    return per_title.select(
        title,
        "year",
        _avg().alias("avg_rating"),
        F.col("row_n").alias("nb_rating"),
        F.sum("row_n").over(Window.partitionBy(title)).alias("nb_total"),
    ).orderBy(title, "year")


def rating_trend(reviews: DataFrame, work_info: DataFrame, titles: Sequence[str]) -> DataFrame:
    """Average rating and count per title and year, with the count over all years."""
    books = work_info.filter(F.col("title").isin(*titles))
    return _trend(reviews, books, "work_refid", "title", "review_date", "parsed_rating")


def rating_trend_star(review: DataFrame, dim_book: DataFrame, titles: Sequence[str]) -> DataFrame:
    books = dim_book.filter(F.col("english_title").isin(*titles))
    return _trend(review, books, "book_id", "english_title", "date_id", "rating")


# -- appreciation by language ------------------------------------------------------


def _by_language(per_title: DataFrame, title: str) -> DataFrame:
    return per_title.select(
        title,
        "review_language",
        _avg().alias("avg_rating"),
        F.col("row_n").alias("nb_rating"),
        _weighted(title).alias("avg_overall"),
    ).orderBy(title, F.desc("nb_rating"), "review_language")


def language_appreciation(
    reviews: DataFrame, work_info: DataFrame, language: DataFrame, titles: Sequence[str]
) -> DataFrame:
    """Rating per title and review language, and the weighted average per title."""
    books = work_info.filter(F.col("title").isin(*titles)).select("work_refid", "title")
    names = language.select(F.col("code").alias("review_lang"), F.col("english_name").alias("review_language"))
    per_book = _reduce(reviews, ["work_refid", "review_lang"], "parsed_rating")
    per_title = _total(
        per_book.join(books, "work_refid").join(names, "review_lang"), ["title", "review_language"]
    )
    return _by_language(per_title, "title")


def language_appreciation_star(
    review: DataFrame, dim_book: DataFrame, dim_language: DataFrame, titles: Sequence[str]
) -> DataFrame:
    books = dim_book.filter(F.col("english_title").isin(*titles)).select("book_id", "english_title")
    codes = dim_language.select(F.col("code").alias("lang_code"))
    per_book = _reduce(review, ["book_id", "lang_code"], "rating")
    joined = per_book.join(books, "book_id").join(codes, "lang_code", "left_semi")
    per_title = _total(
        joined.withColumnRenamed("lang_code", "review_language"), ["english_title", "review_language"]
    )
    return _by_language(per_title, "english_title")


# -- demographics ------------------------------------------------------------------


def demographics(
    reviews: DataFrame,
    work_info: DataFrame,
    user_info: DataFrame,
    user_geo: DataFrame,
    titles: Sequence[str],
    as_of: str,
    open_until: str | None = None,
) -> DataFrame:
    """Rating per title, gender, age and the region valid on the review date."""
    from shelfmark.operators.satellites import join_valid

    books = work_info.filter(F.col("title").isin(*titles)).select("work_refid", "title")
    daily = _total(
        _reduce(reviews, ["work_refid", "user_id", "review_date"], "parsed_rating").join(books, "work_refid"),
        ["title", "user_id", "review_date"],
    )
    placed = join_valid(
        daily, user_geo, "user_id", "review_date", attributes=["region"], open_until=open_until
    )
    age = F.floor(F.months_between(F.lit(as_of).cast("date"), F.col("birth_date")) / 12).cast("int")
    people = user_info.select("user_id", "gender", age.alias("age"))
    grouped = _total(placed.join(people, "user_id", "left"), ["title", "gender", "age", "region"])
    return grouped.select(
        "title", "gender", "age", "region", _avg().alias("avg_rating"), F.col("row_n").alias("nb_rating")
    )


def demographics_star(review: DataFrame, dim_book: DataFrame, dim_reviewer: DataFrame) -> DataFrame:
    """Rating per title, gender and status over all books."""
    people = dim_reviewer.select("reviewer_id", "gender", "status")
    per_book = _reduce(review.join(people, "reviewer_id"), ["book_id", "gender", "status"], "rating")
    per_title = _total(
        per_book.join(dim_book.select("book_id", "english_title"), "book_id"),
        ["english_title", "gender", "status"],
    )
    return per_title.select(
        "english_title",
        "gender",
        "status",
        _avg().alias("avg_rating"),
        F.col("row_n").alias("nb_rating"),
        _weighted("english_title").alias("avg_overall"),
    )


# -- helpful or not ----------------------------------------------------------------


def _helpful(facts: DataFrame, books: DataFrame, key: str, title: str, likes: str, rating: str) -> DataFrame:
    label = F.when(F.col(likes) > 0, "Helpful").otherwise("Not helpful").alias("helpful")
    per_book = _reduce(facts, [key, label], rating)
    per_title = _total(per_book.join(books.select(key, title), key), [title, "helpful"])
    return per_title.select(
        title, "helpful", _avg().alias("avg_rating"), F.col("row_n").alias("nb_rating")
    ).orderBy(title, "helpful")


def helpful_vs_not(reviews: DataFrame, work_info: DataFrame, titles: Sequence[str]) -> DataFrame:
    """Rating of reviews with at least one like against those without."""
    books = work_info.filter(F.col("title").isin(*titles))
    return _helpful(reviews, books, "work_refid", "title", "parsed_likes", "parsed_rating")


def helpful_vs_not_star(review: DataFrame, dim_book: DataFrame, titles: Sequence[str]) -> DataFrame:
    books = dim_book.filter(F.col("title_ori").isin(*titles))
    return _helpful(review, books, "book_id", "title_ori", "nb_likes", "rating")


# -- statistics per site -------------------------------------------------------------


def _per_site(facts, books, sites, key, title, site_name, rating) -> DataFrame:
    per_book = facts.groupBy(key, "site_id").agg(
        F.sum(rating).alias("rating_sum"),
        F.count(rating).alias("rating_n"),
        F.count(F.lit(1)).alias("row_n"),
        F.min(rating).alias("lo"),
        F.max(rating).alias("hi"),
    )
    return (
        per_book.join(books.select(key, title), key)
        .groupBy(title, "site_id")
        .agg(
            F.sum("row_n").alias("nb_reviews"),
            F.round(F.sum("rating_sum") / F.sum("rating_n"), 6).alias("avg_rating"),
            F.min("lo").alias("min_rating"),
            F.max("hi").alias("max_rating"),
        )
        .join(sites, "site_id")
        .select(title, site_name, "nb_reviews", "avg_rating", "min_rating", "max_rating")
        .orderBy(title, site_name)
    )


def site_stats(reviews: DataFrame, work_info: DataFrame, site: DataFrame, titles: Sequence[str]) -> DataFrame:
    """Count, average, lowest and highest rating per title and site."""
    books = work_info.filter(F.col("title").isin(*titles))
    sites = site.select(F.col("id").alias("site_id"), "logical_name")
    return _per_site(reviews, books, sites, "work_refid", "title", "logical_name", "parsed_rating")


def site_stats_star(review: DataFrame, dim_book: DataFrame, dim_site: DataFrame, titles: Sequence[str]) -> DataFrame:
    books = dim_book.filter(F.col("title_ori").isin(*titles))
    sites = dim_site.select("site_id", "name")
    return _per_site(review, books, sites, "book_id", "title_ori", "name", "rating")


def best_authors(
    review: DataFrame, rel_author: DataFrame, dim_author: DataFrame, min_reviews: int = 100
) -> DataFrame:
    """Authors with more than ``min_reviews`` rated reviews, best average first."""
    per_book = (
        review.filter(F.col("rating").isNotNull())
        .groupBy("book_id")
        .agg(F.sum("rating").alias("rating_sum"), F.count(F.lit(1)).alias("n"))
    )
    per_author = (
        rel_author.select("book_id", "author_id")
        .distinct()
        .join(per_book, "book_id")
        .groupBy("author_id")
        .agg(
            F.count(F.lit(1)).alias("nb_books"),
            F.sum("n").alias("nb_reviews"),
            F.sum("rating_sum").alias("rating_sum"),
        )
        .filter(F.col("nb_reviews") > min_reviews)
    )
    return per_author.join(dim_author.select("author_id", "name"), "author_id").select(
        "author_id",
        "name",
        "nb_books",
        "nb_reviews",
        F.round(F.col("rating_sum") / F.col("nb_reviews"), 6).alias("avg_rating"),
    ).orderBy(F.desc("avg_rating"), "author_id")


def site_pivot(
    reviews: DataFrame, work_info: DataFrame, site: DataFrame, site_names: Sequence[str],
    max_popularity: int = 5000,
) -> DataFrame:
    """Average rating per title with one column per site, popular works only."""
    books = work_info.filter(F.col("popularity") < max_popularity).select("work_refid", "title")
    sites = site.select(F.col("id").alias("site_id"), "logical_name")
    per_title = (
        _reduce(reviews, ["work_refid", "site_id"], "parsed_rating")
        .join(books, "work_refid")
        .join(sites, "site_id")
    )
    return (
        per_title.groupBy("title")
        .pivot("logical_name", list(site_names))
        .agg(F.round(F.sum("rating_sum") / F.sum("rating_n"), 6))
        .orderBy("title")
    )


# -- reviewer by book matrix -----------------------------------------------------------


def user_book_matrix(
    reviews: DataFrame,
    work_info: DataFrame,
    work_author: DataFrame,
    author_info: DataFrame,
    user_sameas: DataFrame | None = None,
) -> DataFrame:
    """(user, ``title::author_author``, average rating) rows of the sparse matrix.

    The authors of a work are put together once per work, sorted by name, and meet the
    already reduced (user, work) ratings. With ``user_sameas`` users known to be the
    same person are merged first.
    """
    names = author_info.select("author_id", "name")
    keys = (
        work_author.join(names, "author_id")
        .groupBy("work_refid")
        .agg(F.array_join(F.sort_array(F.collect_list("name")), "_").alias("authors"))
        .join(work_info.select("work_refid", "title"), "work_refid")
        .select("work_refid", F.concat_ws("", "title", F.lit("::"), "authors").alias("book_key"))
    )
    rated = _reduce(reviews, ["user_id", "work_refid"], "parsed_rating")
    if user_sameas is not None:
        same = user_sameas.select("user_id", "same_user_id")
        rated = _total(
            rated.join(same, "user_id", "left").withColumn(
                "user_id", F.coalesce("same_user_id", "user_id")
            ),
            ["user_id", "work_refid"],
        )
    return rated.join(keys, "work_refid").select(
        F.col("user_id").alias("user_key"), "book_key", _avg().alias("rating")
    )


# -- plain statistics --------------------------------------------------------------------


def reviews_per_site(reviews: DataFrame) -> DataFrame:
    """Reviewers, reviews per reviewer and reviews per book, for each site."""
    return reviews.groupBy("site_id").agg(
        F.count_distinct("user_id").alias("nb_reviewers"),
        F.round(F.count(F.lit(1)) / F.count_distinct("user_id"), 6).alias("avg_reviews_per_reviewer"),
        F.round(F.count(F.lit(1)) / F.count_distinct("work_refid"), 6).alias("avg_reviews_per_book"),
    )


def mapped_work_count(mapping: DataFrame, sites: Sequence[int] = (2, 4)) -> DataFrame:
    """Mapped works (found on the site) per site."""
    return (
        mapping.filter(F.col("site_id").isin(*sites) & (F.col("work_uid") != "-1"))
        .groupBy("site_id")
        .agg(F.count(F.lit(1)).alias("nb_mapped"))
    )


def works_without_reviews(work: DataFrame, reviews: DataFrame) -> DataFrame:
    """Number of harvested works no review refers to."""
    reviewed = reviews.select(F.col("work_refid").alias("refid")).distinct()
    return (
        work.filter(F.col("last_harvest_dts").isNotNull())
        .join(reviewed, "refid", "left_anti")
        .agg(F.count_distinct("refid").alias("nb_works"))
    )


def top_books(reviews: DataFrame, work_info: DataFrame, n: int = 20) -> DataFrame:
    """The most reviewed works, labelled ``title (id=n)``."""
    counts = reviews.groupBy("work_refid").agg(F.count(F.lit(1)).alias("nb_reviews"))
    label = F.concat_ws(
        "", "title", F.lit(" (id="), F.col("work_refid").cast("string"), F.lit(")")
    )
    return (
        counts.join(work_info.select("work_refid", "title"), "work_refid")
        .select(label.alias("book"), "nb_reviews")
        .orderBy(F.desc("nb_reviews"), "book")
        .limit(n)
    )


def site_rating_comparison(reviews: DataFrame, sites: dict[str, int]) -> DataFrame:
    """Means, spreads, their differences and correlations of per-work site averages."""
    names = list(sites)
    per_site = []
    for name, site_id in sites.items():
        rating = F.when(F.col("site_id") == site_id, F.col("parsed_rating"))
        per_site += [
            F.avg(rating).alias(f"avg_{name}"),
            F.stddev_samp(rating).alias(f"std_{name}"),
        ]
    stats = reviews.groupBy("work_refid").agg(*per_site)
    out = []
    for name in names:
        out += [
            F.round(F.avg(f"avg_{name}"), 6).alias(f"mean_{name}"),
            F.round(F.avg(f"std_{name}"), 6).alias(f"std_{name}"),
        ]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    for a, b in pairs:
        out += [
            F.round(F.avg(F.col(f"avg_{a}") - F.col(f"avg_{b}")), 6).alias(f"mean_{a}_{b}"),
            F.round(F.avg(F.col(f"std_{a}") - F.col(f"std_{b}")), 6).alias(f"std_{a}_{b}"),
            F.round(F.corr(f"avg_{a}", f"avg_{b}"), 6).alias(f"corr_{a}_{b}"),
        ]
    return stats.agg(*out)


def duplicate_ratio(reviews: DataFrame, similar: DataFrame) -> DataFrame:
    """Totals and averages per work of reviews that take part in a similar pair."""
    ids = (
        similar.select(F.col("review_id").alias("id"))
        .union(similar.select(F.col("other_review_id").alias("id")))
        .distinct()
        .withColumn("copy", F.lit(1))
    )
    per_work = (
        reviews.select("id", "work_refid")
        .join(ids, "id", "left")
        .groupBy("work_refid")
        .agg(F.count("copy").alias("nb_copies"), F.count(F.lit(1)).alias("nb_reviews"))
    )
    return per_work.agg(
        F.sum("nb_copies").alias("copies"),
        F.sum("nb_reviews").alias("reviews"),
        F.round(F.avg("nb_reviews"), 6).alias("reviews_per_work"),
        F.round(F.avg("nb_copies"), 6).alias("copies_per_work"),
        F.round(F.sum("nb_copies") / F.sum("nb_reviews"), 6).alias("copy_share"),
    )


def duplicate_matrix(
    similar: DataFrame, reviews: DataFrame, users: DataFrame, sites: Mapping[str, int],
    shared: Mapping[str, tuple[bool, bool, bool]],
) -> DataFrame:
    """Similar pairs counted inside and across sites and by what both reviews share.

    ``shared`` names combinations of (same reader, same day, same site). Both sides of a
    pair are described by one lookup of the reviews that take part in any.
    """
    ends = similar.select(
        F.struct("review_id", "other_review_id").alias("pair"),
        F.explode(F.array("review_id", "other_review_id")).alias("id"))
    people = users.select(F.col("id").alias("user_id"), "username")
    described = reviews.select("id", "user_id", "site_id", "review_date").join(people, "user_id")
    # The pair has both descriptions, or is left out with the review that has none.
    pairs = (
        ends.join(described, "id").groupBy("pair")
        .agg(F.collect_list(F.struct("username", "review_date", "site_id")).alias("sides"))
        .filter(F.size("sides") == 2)
        .select(F.col("sides")[0].alias("a"), F.col("sides")[1].alias("b"))
    )
    flags = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("username", "review_date", "site_id")]
    kinds = pairs.groupBy(
        F.least("a.site_id", "b.site_id").alias("low"), F.greatest("a.site_id", "b.site_id").alias("high"),
        F.array(*flags).alias("flags"),
    ).agg(F.count(F.lit(1)).alias("n"))

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)

    def between(i: int, j: int) -> Column:
        return (F.col("low") == min(i, j)) & (F.col("high") == max(i, j))

    return kinds.agg(
        *(total(between(i, i), f"inside_{name}") for name, i in sites.items()),
        *(total(between(i, j), f"across_{a}_{b}") for (a, i), (b, j) in combinations(sites.items(), 2)),
        *(total(F.col("flags") == F.array(*map(F.lit, flags)), name) for name, flags in shared.items()),
    )


def lang_histogram(reviews: DataFrame) -> DataFrame:
    """Reviews per language, undefined ones left out, most frequent first."""
    return (
        reviews.withColumn("review_lang", F.rtrim("review_lang"))
        .filter(~F.col("review_lang").isin("--", ""))
        .groupBy("review_lang")
        .agg(F.count(F.lit(1)).alias("nb_reviews"))
        .orderBy(F.desc("nb_reviews"), "review_lang")
    )


def isbn_multiplicity(work_isbn: DataFrame) -> DataFrame:
    """How many eans belong to one, two, ... works."""
    return (
        work_isbn.groupBy("ean")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .groupBy("cnt")
        .agg(F.count(F.lit(1)).alias("nb_ean"))
    )


def reviews_by_site_count(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("site_id").agg(F.count(F.lit(1)).alias("nb_reviews"))


def handy_views(reviews: DataFrame, stage: DataFrame, ledger: DataFrame) -> None:
    """Register the short column subsets people query by hand."""
    reviews.select(
        *[c for c in ("id", "work_refid", "user_id", "site_id", "review_lang", "parsed_rating",
                      "review_date", "load_audit_id") if c in reviews.columns]
    ).createOrReplaceTempView("handy_review")
    stage.select(
        *[c for c in ("id", "work_refid", "dup_refid", "work_uid", "site_logical_name", "username",
                      "user_uid", "rating", "parsed_rating", "review_date", "likes", "parsed_likes")
          if c in stage.columns]
    ).createOrReplaceTempView("handy_staged_review")
    ledger.select(
        "id", "batch_job", "step_name", "status", "run_dts", "rows_impacted"
    ).createOrReplaceTempView("handy_load_audit")
