"""Tables whose rows change, kept as touches and merged when they are read.

A load appends what it says about its keys and neither reads nor rewrites what is stored: a
load of a thousand keys writes a thousand rows whatever the table's size. A touch is a
partial state of its key::

    created          when and by which load, and the columns given to a new row
    one per kind     when and by which load, and the columns this kind of touch sets

Two states of a key combine into the earliest ``created`` and the latest of each kind. That
may be done in any order and grouping, and again with what is already in it, so lots may
arrive late, be written twice, be taken out again, or be folded at any time.

Each load is one partition of the table's folder, named by its load id; folded states have
negative numbers. A row of the table is a key that was created; a kind's columns count where
its touch came after the creation, as they would if the loads had been applied one by one.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampNTZType

from shelfmark.sources.tables import _fs

# A log of fewer rows than one in so many of the folded states is joined to them.
SMALL_LOG = 10
_ORDER = [StructField("at", TimestampNTZType()), StructField("by", IntegerType())]
# Columns of a row that its creation's time and load stand for.
_CREATION = {"create_dts": "at", "load_audit_id": "by"}


@dataclass(frozen=True)
class Touched:
    """Key columns of a table, and the columns each kind of touch sets on known rows."""

    keys: tuple[str, ...]
    sets: Mapping[str, tuple[str, ...]]

    def state(self, layout: StructType) -> StructType:
        """Layout of the states of a table's keys."""
        kinds = {f.name: f for f in layout}
        own = [f for f in layout if f.name not in self.keys and f.name not in _CREATION]
        return StructType([
            *(kinds[k] for k in self.keys),
            StructField("created", StructType([*_ORDER, *own])),
            *(StructField(kind, StructType([*_ORDER, *(kinds[c] for c in columns)])) for kind, columns in self.sets.items()),
        ])


def touches(
    touched: Touched, layout: StructType, staged: DataFrame, at: str, by: int,
    creates: Mapping[str, Column] | None, sets: Mapping[str, Mapping[str, Column]],
) -> DataFrame:
    """States out of staged rows (one per key): what a load says at a time.

    ``creates``: columns of a row that is new; None where the load only touches known rows.
    ``sets``: per kind the columns it sets. Rows with a null in their key say nothing.
    """
    state = touched.state(layout)
    order = [F.lit(at).cast("timestamp_ntz"), F.lit(by).cast("int")]

    def said(field: StructField, values: Mapping[str, Column] | None) -> Column:
        if values is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        rest = [values.get(f.name, F.lit(None)) for f in field.dataType.fields[2:]]
        return F.struct(*(
            v.cast(f.dataType).alias(f.name) for v, f in zip([*order, *rest], field.dataType.fields, strict=True)
        )).alias(field.name)

    known = staged.dropna(subset=list(touched.keys))
    return known.select(
        *touched.keys, said(state["created"], creates), *(said(state[kind], sets.get(kind)) for kind in touched.sets))


def fold(touched: Touched, states: DataFrame) -> DataFrame:
    """One state per key: the earliest creation, the latest touch of each kind."""
    return states.groupBy(*touched.keys).agg(
        F.min("created").alias("created"), *(F.max(kind).alias(kind) for kind in touched.sets))


def combined(touched: Touched, base: DataFrame, log: DataFrame) -> DataFrame:
    """States of ``base`` and ``log`` (each one row per key) as one.

    The log is the small side: where it can be sent to all tasks the base is not shuffled,
    and keys that are new are found by the keys of both, not by whole rows.
    """
    keys = list(touched.keys)
    parts = ["created", *touched.sets]
    newer = log.withColumnsRenamed({c: f"_{c}" for c in parts})
    met = base.join(newer, keys, "left").select(
        *keys, F.least("created", "_created").alias("created"),
        *(F.greatest(kind, f"_{kind}").alias(kind) for kind in touched.sets))
    known = base.select(*keys).join(log.select(*keys), keys, "left_semi")
    return met.unionByName(log.join(known, keys, "left_anti"))


def rows_of(touched: Touched, layout: StructType, states: DataFrame) -> DataFrame:
    """The table's rows out of one state per key; keys never created are no rows."""
    setter = {c: kind for kind, columns in touched.sets.items() for c in columns}

    def column(name: str) -> Column:
        if name in touched.keys:
            return F.col(name)
        if name in _CREATION:
            return F.col(f"created.{_CREATION[name]}").alias(name)
        first, kind = F.col(f"created.{name}"), setter.get(name)
        if kind is None:
            return first.alias(name)
        order = [F.struct(F.col(f"{k}.at"), F.col(f"{k}.by")) for k in (kind, "created")]
        later = F.col(kind).isNotNull() & (order[0] > order[1])
        return F.when(later, F.col(f"{kind}.{name}")).otherwise(first).alias(name)

    return states.filter(F.col("created").isNotNull()).select(*(column(f.name) for f in layout))


class TouchLog:
    """A table kept as touches in a folder, one partition per load.

    Any number of loads may append at once. Folding and taking a load out are for one
    caller at a time; until a fold's partition is whole the folded ones stay, and a state
    met twice is the same as once, so neither a reader nor a broken fold loses or doubles
    anything.
    """

    def __init__(self, spark: SparkSession, folder: str, layout: StructType, touched: Touched):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.layout, self.touched = layout, touched

    def loads(self) -> list[int]:
        """Numbers of the partitions, folded ones (negative) first."""
        fs, path = _fs(self.spark, self.folder)
        if not fs.exists(path):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def _write(self, number: int, states: DataFrame) -> int:
        observed = Observation()
        counted = states.observe(observed, F.count(F.lit(1)).alias("rows"))
        (
            counted.withColumn("batch", F.lit(number)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.folder)
        )
        return observed.get["rows"]

    def append(self, load: int, states: DataFrame) -> int:
        """Write a load's touches in place of those of its earlier attempts; returns their number."""
        written = self._write(load, states)
        if not written:
            self.drop(load)
        return written

    def drop(self, number: int) -> None:
        """Take one partition out; of a load that is not folded yet, all it said is undone."""
        fs, path = _fs(self.spark, f"{self.folder}/batch={number}")
        if fs.exists(path):
            fs.delete(path, True)

    def _states(self, numbers: list[int]) -> DataFrame:
        kinds = StructType([*self.touched.state(self.layout), StructField("batch", IntegerType())])
        stored = self.spark.read.schema(kinds).option("basePath", self.folder)
        return stored.parquet(*(f"{self.folder}/batch={n}" for n in numbers)).drop("batch")

    def state(self) -> DataFrame:
        """One state per key over all partitions."""
        numbers = self.loads()
        folded, log = [n for n in numbers if n < 0], [n for n in numbers if n >= 0]
        if not numbers:
            return self.spark.createDataFrame([], self.touched.state(self.layout))
        if len(folded) != 1:
            return fold(self.touched, self._states(numbers))
        base = self._states(folded)
        if not log:
            return base
        # A small log goes to the base; a large one would be folded for each of the joins: all states meet once.
        said = self._states(log)
        if said.count() * SMALL_LOG > base.count():
            return fold(self.touched, self._states(numbers))
        return combined(self.touched, base, fold(self.touched, said))

    def read(self) -> DataFrame:
        """The table's rows."""
        return rows_of(self.touched, self.layout, self.state())

    def fold(self) -> int:
        """Put all partitions together into one; returns how many they were."""
        numbers = self.loads()
        if len(numbers) < 2 and all(n < 0 for n in numbers):
            return 0
        # The new partition is none of those read.
        self._write(min([*numbers, 0]) - 1, self.state())
        for n in numbers:
            self.drop(n)
        return len(numbers)


def log_of(spark: SparkSession, folder: str, ddl: str, touched: Touched) -> TouchLog:
    """A log of a table with a layout given as text."""
    return TouchLog(spark, folder, StructType.fromDDL(ddl), touched)

