"""Reviews out of arriving dump files: each review once, late ones beside the others.

A stream takes each new file once; what it holds may still have come before, in a file that
was sent again or overlaps. A review is known by the digest of its site, user, work, date
and text. Each micro-batch looks for its digests among the stored reviews of its own span of
dates, so what is read grows with the span, not with all that was ever stored.

Reviews are expected in the harvest period: from the watermark (the last date stored, less
an allowed delay) to the day of the harvest. Those before it, after it or without a date go
to a side table with their period class, also once.

A micro-batch is one ledger step and writes both tables under its load id, so a restart
neither loses nor doubles it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from shelfmark.operators.queues import period_class
from shelfmark.sources.ledger import Ledger
from shelfmark.sources.tables import Store, materialize

SMALL_BATCH = 100_000
KEY = ("site_logical_name", "user_uid", "work_refid", "parsed_review_date", "review")


def review_digest() -> Column:
    """Digest of what makes a review the same one; a field that is null differs from an empty one."""
    return F.unhex(F.sha2(F.to_json(F.struct(*KEY)), 256))


class ReviewIntake:
    """The two tables of a stream of reviews: ``table`` and ``table_late``."""

    def __init__(self, store: Store, table: str, ledger: Ledger, job: str, now: datetime, delay_days: int = 30):
        self.store, self.table, self.late = store, table, f"{table}_late"
        self.ledger, self.job, self.now, self.delay = ledger, job, now, timedelta(days=delay_days)

    def _before(self, name: str, load: int) -> DataFrame | None:
        """Digests and dates of a stored table, without those of an earlier attempt of this load."""
        if not self.store.exists(name):
            return None
        # A table whose loads were all taken out has no file to tell its layout.
        known = self.store.spark.read.schema("digest binary, review_date date, load_audit_id int")
        # Loads of earlier versions hold the digest spelled out.
        spelled = F.octet_length("digest") == 64
        digest = F.when(spelled, F.unhex(F.col("digest").cast("string"))).otherwise(F.col("digest"))
        return known.parquet(self.store.path(name)).filter(F.col("load_audit_id") != load).withColumn("digest", digest)

    def watermark(self, load: int):
        """The last date stored by other loads, less the delay; None before the first."""
        stored = self._before(self.table, load)
        last = None if stored is None else stored.agg(F.max("review_date")).first()[0]
        return None if last is None else last - self.delay

    def _stored(self, rows: DataFrame, load: int) -> DataFrame | None:
        """Digests stored by other loads within the rows' span of dates, and of reviews without a date."""
        first, last, many = rows.agg(F.min("review_date"), F.max("review_date"), F.count(F.lit(1))).first()
        here = F.col("review_date").between(F.lit(first), F.lit(last)) | F.col("review_date").isNull()
        tables = [t for t in (self._before(name, load) for name in (self.table, self.late)) if t is not None]
        if not tables:
            return None
        stored = reduce(DataFrame.unionByName, (t.filter(here).select("digest") for t in tables))
        # A small batch goes to the stored digests, which stay; beside a large one they move as they are.
        return stored.join(rows.select("digest"), "digest", "left_semi") if many <= SMALL_BATCH else stored

    def _new(self, rows: DataFrame, load: int) -> DataFrame:
        """One row per digest that is in neither table, without the digest, which is longer than most rows.

        Rows and stored digests meet in the one shuffle that finds the rows sent twice.
        """
        rest = F.struct(*(c for c in rows.columns if c != "digest"))
        sent, stored = rows.select("digest", rest.alias("sent")), self._stored(rows, load)
        if stored is not None:
            sent = sent.unionByName(stored.withColumn("known", F.lit(True)), allowMissingColumns=True)
        else:
            sent = sent.withColumn("known", F.lit(None).cast("boolean"))
        met = sent.groupBy("digest").agg(F.max("sent").alias("sent"), F.max("known").alias("known"))
        return met.filter("known is null").select("sent.*")

    def _write(self, name: str, rows: DataFrame, load: int) -> int:
        observed = Observation()
        self.store.append_batch(
            name, rows.withColumn("digest", review_digest()).withColumn("load_audit_id", F.lit(load)).observe(observed, F.count(F.lit(1)).alias("rows")))
        count = observed.get["rows"]
        if not count:
            self.store.drop_batch(name, load)
        return count

    def load(self, rows: DataFrame, load: int) -> int:
        """Store a batch of staged rows; returns how many reviews it added to the table."""
        dated = rows.withColumn("review_date", F.col("parsed_review_date").try_cast("date")).withColumn("digest", review_digest())
        mark, until = self.watermark(load), F.lit(self.now.date() + timedelta(days=1))
        classed = materialize(
            self._new(dated, load).withColumn(
                "period_class", period_class("review_date", None if mark is None else F.lit(mark), until)), "intake")
        on_time = F.coalesce(F.col("period_class") == 0, F.lit(False))
        self._write(self.late, classed.filter(~on_time), load)
        return self._write(self.table, classed.filter(on_time).drop("period_class"), load)

    def sink(self) -> Callable[[DataFrame, int], None]:
        """What a stream calls with each micro-batch."""
        def take(rows: DataFrame, batch_id: int) -> None:
            self.ledger.run(
                self.job, f"{self.table} batch {batch_id}",
                lambda load: None if rows.isEmpty() else self.load(rows, load), self.now)

        return take
