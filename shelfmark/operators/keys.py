"""Surrogate ids that stay.

A registry holds (key, id) of every key that ever got an id. A build asks it for its keys:
those known keep their id, whatever else has come or gone since; new ones get the next
numbers after the highest, in key order and without gaps. What a build adds is appended as
one lot under its load id, so a registry is never rewritten, and facts of earlier builds
stay right. One build at a time registers keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.operators.merge import dense_ids


def new_keys(known: DataFrame, wanted: DataFrame, key: str, name: str) -> DataFrame:
    """(key, id) of the keys of ``wanted`` that ``known`` does not have; null keys get none.

    ``wanted`` may repeat keys. Only keys travel: known ones are left out before the new ones
    are ranked, so a build pays for what is new.
    """
    keys = wanted.select(key).filter(F.col(key).isNotNull()).distinct()
    highest = known.agg(F.max(name)).first()[0] or 0
    return dense_ids(keys.join(known.select(key), key, "left_anti"), key, name, start=highest + 1).select(key, name)


def with_ids(rows: DataFrame, registry: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the id of their key in front; rows whose key is not registered are left out."""
    return rows.join(registry.select(key, name), key).select(name, *rows.columns)
