"""Set-based merge shapes shared by the loads.

A load takes the stored table and the staged rows. Two results exist:

* *upsert* returns the whole next state, since matched rows change;
* *missing_rows* returns only the rows to add, so a caller appends one batch and
  never rewrites the stored table.

Staged rows are reduced to one row per key before they meet the stored table: both
sides of every join below are unique on the key, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def upsert(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    on_match: Mapping[str, Column],
    on_insert: Mapping[str, Column],
) -> DataFrame:
    """Next state of ``target`` after matching ``stage`` on ``keys``.

    ``stage`` has one row per key. Expressions may name ``s.x`` (staged) and ``t.x``
    (stored). One full outer join, hence one shuffle of each side; a stored row without
    staged partner passes unchanged.
    """
    t = target.withColumn("_stored", F.lit(True)).alias("t")
    s = stage.withColumn("_staged", F.lit(True)).alias("s")
    condition = None
    for key in keys:
        term = F.col(f"t.{key}") == F.col(f"s.{key}")
        condition = term if condition is None else condition & term
    stored, staged = F.col("_stored").isNotNull(), F.col("_staged").isNotNull()
    out = []
    for field in target.schema:
        name = field.name
        if name in keys:
            value = F.coalesce(F.col(f"t.{name}"), F.col(f"s.{name}"))
        else:
            kept = F.col(f"t.{name}")
            value = (
                F.when(stored & staged, on_match.get(name, kept))
                .when(stored, kept)
                .otherwise(on_insert.get(name, F.lit(None)))
            )
        out.append(value.cast(field.dataType).alias(name))
    return t.join(s, condition, "full_outer").select(*out)


def one_per_key(stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One staged row per key: of several the greatest, compared column by column."""
    rest = [c for c in stage.columns if c not in keys]
    best = stage.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in stage.columns])


def missing_rows(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows (one per key) whose key is not stored yet."""
    return stage.join(target.select(*keys), list(keys), "left_anti")


def stamped(df: DataFrame, now: str, batch_id: int, *dates: str) -> DataFrame:
    """Add creation time, load id and any further date columns set to the load time."""
    df = df.withColumn("create_dts", F.lit(now).cast("timestamp_ntz")).withColumn(
        "load_audit_id", F.lit(batch_id).cast("int")
    )
    for name in dates:
        df = df.withColumn(name, F.lit(now).cast("date"))
    return df


def add_ids(rows: DataFrame, after: int, name: str = "id") -> DataFrame:
    """Unique ids above ``after`` for rows about to be appended; gaps are allowed."""
    return rows.withColumn(name, F.monotonically_increasing_id() + F.lit(after + 1))


def dense_ids(rows: DataFrame, key: str, name: str, start: int = 1) -> DataFrame:
    """Consecutive ids in key order without a single-task window.

    Rows are range partitioned and sorted, and written to the checkpoint folder so that
    positions are fixed even when executors are lost; then each partition gets the
    number of rows before it. The prefix sum runs over one row per partition.
    """
    from pyspark.sql import Window

    from shelfmark.session import shared_folder

    shared_folder(rows.sparkSession)
    placed = (
        rows.repartitionByRange(F.col(key))
        .sortWithinPartitions(key)
        .withColumn("_pos", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_pos", 33))
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_pos").bitwiseAND((1 << 33) - 1)
    return placed.join(offsets, "_part").select(
        (F.col("_offset") + position + start).cast("long").alias(name), *rows.columns
    )
