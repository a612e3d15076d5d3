"""URL filter: explicit rules, then an empirical-Bayes reputation of hosts.

A page with a labelled outcome (good or not) counts for its host, the host's registered
domain (last two labels) and the domain's suffix (last label). Rates are shrunk top down:
the suffix towards the rate of all pages, the domain towards its suffix, the host towards
its domain. At every level the prior is a beta distribution with the parent's shrunk rate
as its mean and a strength fitted over the level by the method of moments. A page without
a rule is allowed if the lower bound of its host's posterior reaches ``least``. Hosts that
have no label take their domain's or suffix's posterior, widened to the prior.

Built-in expressions only. Pages are counted per host before anything is joined, so a host
with a third of all pages is a few partial rows; the lookup joins pages on the host against
one row per host, and its page side can be split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.common import saved

LEAST = 0.5  # least posterior bound of the share of good pages
DEVIATIONS = 1.64  # of the posterior, below its mean
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0  # of a prior, in pages


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains, for paths that start with its path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; "" without ``://``."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _longest(rules: Sequence[Rule], host: Column, path: Column, of) -> Column:
    out = None
    for rule in sorted(rules, key=lambda r: len(r.text), reverse=True):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(of(rule))) if out is None else out.when(fits, F.lit(of(rule)))
    return out if out is not None else F.lit(None).cast("string")


def registered_domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _strength(level: DataFrame) -> float:
    """Prior strength of a level (columns n, good, parent).

    Method of moments: with rates p around parents m, E (p - m)^2 = m (1 - m) (1/n + (1 - 1/n) / (1 + s)),
    weighted by n and solved for s. No spread beyond chance means the largest strength.
    """
    n, chance = F.col("n"), F.col("parent") * (1 - F.col("parent"))
    got = F.sum(n * F.pow(F.col("good") / n - F.col("parent"), 2))
    rest = F.sum(n * chance * (1 - 1 / n))
    over = level.filter("n > 0").agg(((got - F.sum(chance)) / F.when(rest > 0, rest))).first()[0]
    if over is None or over <= 0:
        return MOST_STRENGTH
    return max(LEAST_STRENGTH, min(MOST_STRENGTH, 1 / over - 1))


def _shrunk(strength: float) -> Column:
    """A level's rate (columns n, good, parent) drawn towards its parent's."""
    return (F.col("good") + F.lit(strength) * F.col("parent")) / (F.col("n") + F.lit(strength))


def reputations(hosts: DataFrame, outcomes: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """host, rate and bound of every host in ``hosts`` (one row each).

    ``outcomes``: host, n (labelled pages) and good (of them good), one row per labelled
    host. Without any outcome the rate of all pages is taken as a half. The levels are
    small tables of sums; the driver sees the overall rate and one strength per level.
    """
    every = saved(
        hosts.select("host").join(outcomes, "host", "left").na.fill(0, ["n", "good"])
        .withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix(F.col("host"))), "hosts")
    n, good = every.agg(F.sum("n"), F.sum("good")).first()
    whole = ((good or 0) + 0.5) / ((n or 0) + 1.0)
    domains = every.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn(
        "suffix", suffix(F.col("domain")))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn(
        "parent", F.lit(whole))
    rates = suffixes.select("suffix", _shrunk(_strength(suffixes)).alias("parent"))
    domains = saved(domains.join(rates, "suffix"), "domains")
    rates = domains.select("domain", _shrunk(_strength(domains)).alias("parent"))
    level = saved(every.join(rates, "domain"), "host-levels")
    strength = _strength(level)
    rate = _shrunk(strength)
    spread = F.sqrt(rate * (1 - rate) / (F.col("n") + F.lit(strength) + 1))
    return level.select("host", rate.alias("rate"), F.greatest(F.lit(0.0), rate - deviations * spread).alias("bound"))


def page_document(path: Column) -> Column:
    """The number of the document a page shows: the digits its last path segment begins with."""
    return F.regexp_extract(path, r"/([0-9]+)[^/]*/?$", 1).try_cast("bigint")


def judged_pages(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule],
    least: float = LEAST, deviations: float = DEVIATIONS,
) -> DataFrame:
    """page_id, host, path, rule, verdict, rate and bound of every page.

    ``pages``: page_id, url. ``labels``: doc_id, quality; a page's outcome is the quality of
    the document its path names, 0 or 1. A document marked both ways, or null, is no
    outcome. A null url or one without ``://`` has an empty host and path and is judged as
    the host "". Rows are judged one by one, so repeated and null ids need no rule.
    """
    split = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    split = split.withColumn("doc_number", page_document(F.col("path")))
    marks = (
        labels.filter("quality in (0, 1) and doc_id is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_number"))
        .agg(F.min("quality").alias("mark"), F.max("quality").alias("other"))
        .filter("mark = other").select("doc_number", "mark")
    )
    counted = split.filter("doc_number is not null").groupBy("host", "doc_number").count()
    outcomes = counted.join(marks, "doc_number").groupBy("host").agg(
        F.sum("count").alias("n"), F.sum(F.col("count") * F.col("mark")).alias("good"))
    hosts = saved(reputations(split.select("host").distinct(), outcomes, deviations), "reputations")
    fit = split.join(hosts, "host")
    host, path = F.col("host"), F.col("path")
    by_rule = _longest(rules, host, path, lambda r: r.verdict)
    return fit.select(
        "page_id", "host", "path", _longest(rules, host, path, lambda r: r.text).alias("rule"),
        F.coalesce(by_rule, F.when(F.col("bound") >= least, "allow").otherwise("block")).alias("verdict"),
        "rate", "bound")
