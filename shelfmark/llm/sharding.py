"""Contiguous, byte-balanced shards by global prefix sums.

Rows are put in order by a range partitioning and sorted within each partition. Every
partition's total of bytes and rows (one row per partition) gives the offset its rows
start at; with the running sums inside the partition each row knows how many bytes lie
before it in the whole input. Cutting that line into equal lengths gives the shards.

Only ids, sizes and checksums are shuffled, never texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.common import prepared, saved

SHARDS = 24
ROW_BYTES = 8  # what a row weighs beside its text


def _running(columns: list[str]):
    """Running sum of bytes and count of rows before each row of the task's partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = 0, 0
        for batch in batches:
            own = batch.column("size").to_numpy()
            before = size + np.cumsum(own) - own
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before), pa.array(np.arange(rows, rows + len(own)))],
                [*columns, "bytes_before", "rows_before"])
            size, rows = size + int(own.sum()), rows + len(own)

    return run


def prefix_sums(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """``rows`` (with a long column size) and the bytes and rows before each in the order.

    Rows equal in the whole order keep one of their possible orders. The sorted rows are
    written once, so partitions and sums belong to the same cut of the ranges.
    """
    spark = rows.sparkSession
    prepared(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ordered = ordered.withColumn("part", F.spark_partition_id())
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
    placed = saved(
        ordered.mapInArrow(_running(ordered.columns), f"{layout}, bytes_before long, rows_before long"), "sorted-rows")
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    offsets, size, count = [], 0, 0
    for r in sorted(totals, key=lambda r: r["part"]):  # one row per partition
        offsets.append((r["part"], size, count))
        size, count = size + r["bytes"], count + r["rows"]
    offset = F.broadcast(spark.createDataFrame(offsets, "part int, bytes_offset long, rows_offset long"))
    return placed.join(offset, "part").select(
        *rows.columns, (F.col("bytes_before") + F.col("bytes_offset")).alias("bytes_before"),
        (F.col("rows_before") + F.col("rows_offset")).alias("rows_before"), F.lit(size).cast("long").alias("all_bytes"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row, in the order of doc_id.

    A row's size is its text's UTF-8 bytes plus ROW_BYTES; a null text has none. The row
    goes to the shard its middle byte lies in, so shards are contiguous in doc_id and
    differ from an equal share by at most one row at either end. Rows of one id are in the
    order of checksum and size, null ids come first. No rows give no shards.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"))
    # Equal rows are told apart by their place, so that very many of them still spread.
    spread = F.monotonically_increasing_id()
    placed = prefix_sums(rows.withColumn("place", spread), ["doc_id", "text_crc32", "size", "place"])
    middle = 2 * F.col("bytes_before") + F.col("size")
    shard = F.least(F.floor(middle * shards / (2 * F.col("all_bytes"))), F.lit(shards - 1)).cast("int")
    placed = placed.withColumn("shard", shard)
    first = placed.groupBy("shard").agg(F.min("rows_before").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rows_before") - F.col("first")).alias("slot"))
