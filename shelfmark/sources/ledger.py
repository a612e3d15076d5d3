"""Run ledger: one row when a step starts, one when it ends."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

RUNNING, COMPLETED, FAILED, EMPTY = "Running", "Completed", "Failed", "Empty"
SKIPPED = "Skipped"
SCHEMA = (
    "id int, batch_job string, step_name string, status string, run_dts timestamp, "
    "elapse_sec int, rows_impacted bigint, output string"
)


def ledger_latest(ledger: DataFrame) -> DataFrame:
    """The latest entry of every (job, step); at equal times the further stage counts."""
    stage = F.array_position(F.array(*[F.lit(x) for x in (RUNNING, FAILED, EMPTY, COMPLETED)]), F.col("status"))
    order = F.struct("run_dts", stage.alias("stage"), "status", "rows_impacted")
    return (
        ledger.groupBy("batch_job", "step_name")
        .agg(F.max(order).alias("last"))
        .select("batch_job", "step_name", "last.status", "last.run_dts", "last.rows_impacted")
    )


class Ledger:
    """Ledger kept as a parquet folder that is only ever appended to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def _append(self, *row) -> None:
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def _entries(self) -> DataFrame:
        try:
            return self.read()
        except AnalysisException:
            # Nothing was ever entered: there is no folder yet.
            return self.spark.createDataFrame([], SCHEMA)

    def state(self, job: str, step: str) -> tuple[int | None, int, bool]:
        """Load id of a step from before, the highest id entered, and whether the step is done."""
        this = (F.col("batch_job") == job) & (F.col("step_name") == step)
        row = self._entries().agg(
            F.max(F.when(this, F.col("id"))).alias("own"),
            F.max("id").alias("last"),
            F.count_if(this & (F.col("status") == COMPLETED)).alias("done"),
        ).first()
        return row["own"], row["last"] or 0, row["done"] > 0

    def _claim(self, after: int) -> int:
        """The next free load id. Creating its empty file fails if another job has it."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        number = after + 1
        while True:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}_ids/{number}")
            if path.getFileSystem(conf).createNewFile(path):
                return number
            number += 1

    def run(self, job: str, step: str, work: Callable[[int], int | None], now: datetime) -> str:
        """Run a step once. A completed step is skipped; a failed one may be run again.

        ``work`` gets the load id and returns the rows it wrote, or None when its input
        was empty. It must replace what an earlier attempt under the same id wrote. The
        status is returned, so that a flow can stop at an empty input.
        """
        batch, last, done = self.state(job, step)
        if done:
            return SKIPPED
        if batch is None:
            batch = self._claim(last)
        self._append(batch, job, step, RUNNING, now, None, None, None)
        started = datetime.now()
        try:
            rows = work(batch)
        except Exception as e:
            elapsed = (datetime.now() - started).seconds
            self._append(batch, job, step, FAILED, now, elapsed, None, str(e))
            raise
        elapsed = (datetime.now() - started).seconds
        status = EMPTY if rows is None else COMPLETED
        self._append(batch, job, step, status, now, elapsed, rows or 0, None)
        return status
