"""Changes laid over the reviews when they are read.

A patch says of one review that it is deleted, or that a column has another value (NULL is
a value). Patches are appended under their load id and the stored reviews stay as they are:
of several patches of a column the one of the highest load counts, a deletion counts whatever
else is said. Taking a load's patches out undoes it. Patches may be worked into the stored
rows at any time; doing so twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

PATCH = "id bigint, column string, value string, deleted boolean, load_audit_id int"


def value_patch(rows: DataFrame, column: str, value: Column, batch: int) -> DataFrame:
    """Patches that set a column of the given rows (id)."""
    return rows.select(
        "id", F.lit(column).alias("column"), value.cast("string").alias("value"), F.lit(False).alias("deleted"),
        F.lit(batch).cast("int").alias("load_audit_id"))


def deletion_patch(rows: DataFrame, batch: int) -> DataFrame:
    """Patches that delete the given rows (id)."""
    gone = rows.select("id").distinct()
    nothing = F.lit(None).cast("string")
    return gone.select(
        "id", nothing.alias("column"), nothing.alias("value"), F.lit(True).alias("deleted"),
        F.lit(batch).cast("int").alias("load_audit_id"))


def folded(patches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per patched review: whether it is deleted, and per column the last value with its load."""
    said = F.struct("load_audit_id", "value")
    return patches.groupBy("id").agg(
        F.max("deleted").alias("_deleted"),
        *(F.max(F.when(F.col("column") == c, said)).alias(f"_{c}") for c in columns))


def laid_over(rows: DataFrame, patches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` (id, unique) as the patches have them; only the named columns can be patched.

    The patches are reduced to one row per review before they meet the rows; where they are
    few they are sent to the rows, which then stay where they are.
    """
    def patched(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        last = F.col(f"_{name}")
        value = last["value"].cast(rows.schema[name].dataType)
        return F.when(last.isNotNull(), value).otherwise(F.col(name)).alias(name)

    met = rows.join(folded(patches, columns), "id", "left")
    return met.filter(~F.coalesce("_deleted", F.lit(False))).select(*(patched(c) for c in rows.columns))
