"""Historised attributes: building validity intervals and joining facts to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def close_intervals(versions: DataFrame, key: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Close each version at the start of the next one; the last stays open (NULL).

    ``versions`` holds one row per (key, start date), so a key's window is bounded by
    the number of days in the history, not by the number of facts.
    """
    following = Window.partitionBy(key).orderBy(start)
    return versions.withColumn(end, F.lead(start).over(following))


def join_valid(
    facts: DataFrame,
    intervals: DataFrame,
    key: str,
    date: str,
    *,
    attributes: list[str],
    start: str = "valid_from",
    end: str = "valid_to",
    open_until: str | None = None,
) -> DataFrame:
    """Left join of facts to the interval with ``start <= date < end`` of the same key.

    An open interval matches nothing unless ``open_until`` names the date to close it
    at. The key is extended by the calendar month: an interval is repeated for the
    months it covers, a fact carries its own, so one busy key spreads over many tasks
    and each fact meets only the intervals of its month.
    """
    horizon = F.lit(open_until).cast("date")
    closed = intervals.select(
        F.col(key),
        F.col(start).alias("_start"),
        F.coalesce(F.col(end), horizon).alias("_end"),
        *attributes,
    ).filter(F.col("_end").isNotNull() & (F.col("_start") < F.col("_end")))

    def month(d: Column | str) -> Column:
        return F.year(d) * 12 + F.month(d)

    spread = closed.withColumn(
        "_month",
        F.explode(F.sequence(month("_start"), month(F.date_sub("_end", 1)))),
    )
    f, i = facts.withColumn("_month", month(date)).alias("f"), spread.alias("i")
    condition = (
        (F.col(f"f.{key}") == F.col(f"i.{key}"))
        & (F.col("f._month") == F.col("i._month"))
        & (F.col(f"f.{date}") >= F.col("i._start"))
        & (F.col(f"f.{date}") < F.col("i._end"))
    )
    return f.join(i, condition, "left").select(
        *[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"i.{c}") for c in attributes]
    )
