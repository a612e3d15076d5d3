"""Incremental ingest of dump files.

New files of a folder are loaded in micro-batches; the stream's checkpoint remembers the
files already taken, in place of a marker per task. Each micro-batch is a step of the run
ledger with a load id of its own, so a repeated batch replaces itself and never meets the
rows of another load. The stream stops when no file is left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.schemas import text_schema
from shelfmark.sources.ledger import Ledger
from shelfmark.sources.tables import Store


def ingest_dumps(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str],
    checkpoint: str,
    load: Callable[[DataFrame, int], None],
    files_per_batch: int = 1000,
    header: bool = True,
) -> None:
    """Load all new files.

    All files of the folder have the same column order. ``load(rows, batch_id)`` writes.
    """
    reader = (
        spark.readStream.schema(text_schema(tuple(columns)))
        .option("header", header)
        .option("sep", "|")
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "\\N")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    run = (
        reader.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def into_store(
    store: Store, table: str, ledger: Ledger, job: str, now: datetime
) -> Callable[[DataFrame, int], None]:
    """Append each micro-batch to a table under the load id of its ledger step."""

    def load(rows: DataFrame, batch_id: int) -> None:
        def write(load_id: int) -> int | None:
            if rows.isEmpty():
                return None
            store.append_batch(table, rows.withColumn("load_audit_id", F.lit(load_id)))
            return store.read(table).filter(F.col("load_audit_id") == load_id).count()

        ledger.run(job, f"{table} batch {batch_id}", write, now)

    return load
