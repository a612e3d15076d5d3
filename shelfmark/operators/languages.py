"""Language detection of review texts.

Naive Bayes over character trigrams. A profile holds, per trigram, in how many training
texts of each language it occurs; a text's score is the sum over its own trigrams. The
profile grows with the alphabets, not with the texts: it is broadcast while its counted
rows stay within a bound, and shuffled beyond; the texts' side is never broadcast.

Trigram sets are unpacked with the outer form of explode: for the inner form the optimizer
derives a not-empty filter and computes the sets a second and third time below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.functions.text import trigrams
from shelfmark.sources.tables import materialize, spread

# Shorter texts and less certain answers are undetermined.
MIN_DETECT_SIZE = 30
MIN_DETECT_PROB = 0.70
UNDETERMINED = "und"

BROADCAST_ROWS = 400_000  # trigrams of a profile that is sent to all executors, at most
WIDE_LANGUAGES = 64  # languages up to which a trigram's weights are columns of one row


def with_sets(texts: DataFrame, key: str = "id", text: str = "review") -> DataFrame:
    """``texts`` with grams, their trigram sets, built once and spread over all cores.

    Training and detection take the sets from there instead of building their own.
    """
    return materialize(spread(texts, key).withColumn("grams", trigrams(text)), "trigram-sets")


def _sets(texts: DataFrame, text: str) -> Column:
    return F.col("grams") if "grams" in texts.columns else trigrams(text)


def train_profiles(labelled: DataFrame, text: str = "review", lang: str = "review_lang") -> DataFrame:
    """(gram, langs) rows from texts whose language is known.

    ``langs`` holds, per language that has the trigram, its weight (the logarithm of the
    count plus one) and the language's size (the logarithm of its smoothed total).
    """
    counted = materialize(
        labelled.filter(F.col(lang).isNotNull())
        .select(F.col(lang).alias("lang"), F.explode_outer(_sets(labelled, text)).alias("gram"))
        .filter(F.col("gram").isNotNull())
        .groupBy("lang", "gram")
        .agg(F.count(F.lit(1)).alias("n")),
        "gram-counts",
    )
    totals = counted.groupBy("lang").agg(F.log(F.sum("n") + F.count(F.lit(1))).alias("size"))
    entry = F.struct("lang", F.log(F.col("n") + F.lit(1)).alias("weight"), "size")
    # One entry per language in each list.
    return materialize(
        counted.join(totals, "lang").groupBy("gram").agg(F.collect_list(entry).alias("langs")), "profiles")


def classify(texts: DataFrame, profiles: DataFrame, key: str = "id", text: str = "review") -> DataFrame:
    """(key, lang, probability) of the most probable language of each text.

    All trigrams of a text lie in one partition, so against a broadcast profile the sums
    are combined before the shuffle to one row per text and language.
    """
    small = profiles.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    sets = texts.select(key, _sets(texts, text).alias("grams")).withColumn("n", F.size("grams"))
    grams = sets.select(key, "n", F.explode_outer("grams").alias("gram"))
    sizes = profiles.select(F.inline("langs")).groupBy("lang").agg(F.max("size").alias("size")).orderBy("lang").limit(
        WIDE_LANGUAGES + 1).collect()
    if len(sizes) <= WIDE_LANGUAGES:
        # A column per language: a trigram stays one row, and its weights are added up in it.
        by_lang = F.map_from_entries(F.transform("langs", lambda e: F.struct(e["lang"], e["weight"])))
        known = profiles.select("gram", by_lang.alias("m")).select(
            "gram", *(F.coalesce(F.col("m")[r["lang"]], F.lit(0.0)).alias(f"w{i}") for i, r in enumerate(sizes)))
        found = (
            grams.join(F.broadcast(known) if small else known.hint("merge"), "gram").groupBy(key)
            .agg(F.max("n").alias("n"), *(F.sum(f"w{i}").alias(f"w{i}") for i in range(len(sizes))))
        )
        entries = [
            F.when(F.col(f"w{i}") > 0, F.struct((F.col(f"w{i}") - F.col("n") * r["size"]).alias("score"), F.lit(r["lang"]).alias("lang")))
            for i, r in enumerate(sizes)]
        best = found.select(key, F.filter(F.array(*entries), lambda e: e.isNotNull()).alias("all")).select(
            key, F.array_max("all").alias("top"), F.col("all.score").alias("scores"))
        return _most_probable(best, key) if sizes else sets.limit(0).selectExpr(key, "'' as lang", "0.0d as probability")
    known = F.broadcast(profiles) if small else profiles.hint("merge")
    hits = (
        grams.join(known, "gram")
        .select(key, "n", F.inline("langs"))
        .groupBy(key, "lang")
        .agg(F.sum("weight").alias("found"), F.max("n").alias("n"), F.max("size").alias("size"))
    )
    scored = hits.select(key, "lang", (F.col("found") - F.col("n") * F.col("size")).alias("score"))
    # One entry per language and text.
    best = scored.groupBy(key).agg(
        F.max(F.struct("score", "lang")).alias("top"), F.collect_list("score").alias("scores")
    )
    return _most_probable(best, key)


def _most_probable(best: DataFrame, key: str) -> DataFrame:
    """The best language (top) with its share among all scores."""
    certainty = 1 / F.aggregate(
        F.col("scores"), F.lit(0.0), lambda acc, s: acc + F.exp(s - F.col("top.score"))
    )
    return best.select(key, F.col("top.lang").alias("lang"), certainty.alias("probability"))


def detect_language(
    texts: DataFrame, profiles: DataFrame, key: str = "id", text: str = "review", out: str = "detected_lang"
) -> DataFrame:
    """Texts with their language; short or uncertain ones are undetermined, empty ones NULL."""
    found = classify(texts.filter(F.length(text) >= MIN_DETECT_SIZE), profiles, key, text)
    certain = (F.col("_length") >= MIN_DETECT_SIZE) & (F.col("probability") >= MIN_DETECT_PROB)
    # The length is taken below the join, so that a caller who drops the text does not shuffle it.
    return (
        texts.withColumn("_length", F.length(text))
        .join(found.withColumnRenamed("lang", "_lang"), key, "left")
        .withColumn(out, F.when(F.col("_length") > 0, F.when(certain, F.col("_lang")).otherwise(UNDETERMINED)))
        .drop("_lang", "_length", "probability")
    )


def batch_detect_language(reviews: DataFrame, profiles: DataFrame, to_marc: dict[str, str] | None = None) -> DataFrame:
    """Fill the language of reviews that have a text and no language, in one pass."""
    found = found_languages(reviews, profiles, to_marc)
    return (
        reviews.join(found, "id", "left")
        .withColumn("review_lang", F.coalesce("review_lang", "detected_lang"))
        .drop("detected_lang")
    )


def found_languages(reviews: DataFrame, profiles: DataFrame, to_marc: dict[str, str] | None = None) -> DataFrame:
    """id and detected_lang of the reviews that have a text and no language."""
    open_ones = reviews.filter(F.col("review_lang").isNull() & F.col("review").isNotNull())
    sets = [c for c in ("grams",) if c in reviews.columns]
    found = detect_language(open_ones.select("id", "review", *sets), profiles).select("id", "detected_lang")
    if to_marc:
        codes = F.create_map(*[F.lit(x) for pair in to_marc.items() for x in pair])
        found = found.withColumn("detected_lang", F.coalesce(codes[F.col("detected_lang")], "detected_lang"))
    return found


def lang_prior(reviews: DataFrame, min_length: int = 100) -> DataFrame:
    """Share of each language among longer texts, largest first."""
    counts = (
        reviews.filter(F.length("review") >= min_length)
        .groupBy("review_lang")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One row per language.
    share = F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select("review_lang", F.round(share, 9).alias("ratio")).orderBy(F.desc("ratio"), "review_lang")
