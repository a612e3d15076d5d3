"""Tables kept as parquet folders.

A table that is replaced as a whole gets its next state in a new version folder, which counts
from the moment its writer has marked it complete: a reader finds the last complete state.
A table written by partitions (loads, sites) is overwritten partition by partition with
Spark's dynamic overwrite, which is not atomic: a reader of a partition that is being
rewritten may find it missing and has to read again. Each table has one writer at a time; two
that replace it at once would both take the next version, and one state would be lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.session import shared_folder

KEPT_VERSIONS = 2  # the current version and one that readers may still be at


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Cuts the lineage where a result is read several times; later steps read only the
    columns they name, and survive the loss of the executors that made it. The table
    stays until ``drop_intermediate``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    made = spark.sparkContext.__dict__.setdefault("_shelfmark_tables", [])
    made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside drop their shuffle files as soon as they end: nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_intermediate(spark: SparkSession) -> int:
    """Delete the intermediate tables this session has made; frames over them end here."""
    made = spark.sparkContext.__dict__.setdefault("_shelfmark_tables", [])
    for path in made:
        fs, hadoop_path = _fs(spark, path)
        fs.delete(hadoop_path, True)
    count = len(made)
    made.clear()
    return count


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Partition by the columns, or in equal parts, into the configured number of shuffle partitions.

    For rows that are small but costly to work on: the partition count is kept, where
    adaptive execution would merge partitions by their bytes. A shuffled join on the
    same columns uses this exchange and adds none.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


class Store:
    """Named tables under one root folder.

    ``replace`` publishes a whole next state, ``append_batch`` adds or rewrites one
    load's rows, ``replace_partition`` rewrites the partitions present in the rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def exists(self, name: str) -> bool:
        fs, path = _fs(self.spark, f"{self.root}/{name}")
        return fs.exists(path)

    def _versions(self, name: str) -> list[str]:
        """Complete versions, oldest first."""
        fs, path = _fs(self.spark, f"{self.root}/{name}")
        if not fs.exists(path):
            return []
        names = sorted(f.getPath().getName() for f in fs.listStatus(path))
        done = [n for n in names if n.startswith("v-")]
        return [n for n in done if fs.exists(_fs(self.spark, f"{self.root}/{name}/{n}/_SUCCESS")[1])]

    def path(self, name: str) -> str:
        """Folder of the current version; unversioned tables are their own folder."""
        versions = self._versions(name)
        return f"{self.root}/{name}/{versions[-1]}" if versions else f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Publish a next state of a table that may be computed from its current one."""
        versions = self._versions(name)
        number = int(versions[-1].split("-")[1]) + 1 if versions else 1
        df.write.parquet(f"{self.root}/{name}/v-{number:09d}-{uuid.uuid4().hex}")
        for old in self._versions(name)[:-KEPT_VERSIONS]:
            fs, path = _fs(self.spark, f"{self.root}/{name}/{old}")
            fs.delete(path, True)
        return self.read(name)

    def append_batch(self, name: str, df: DataFrame) -> None:
        """Write rows under their load id; repeating a load replaces its own rows."""
        self._partitioned(name, df, "load_audit_id")

    def replace_partition(self, name: str, df: DataFrame, column: str) -> None:
        """Replace the partitions the rows belong to and leave all others."""
        self._partitioned(name, df, column)

    def _partitioned(self, name: str, df: DataFrame, column: str) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(f"{self.root}/{name}")
        )

    def truncate_and_load(self, name: str, df: DataFrame) -> DataFrame:
        """Replace all rows of a staging table."""
        return self.replace(name, df)

    def drop_partition(self, name: str, column: str, value) -> None:
        """Take one partition out of a partitioned table."""
        fs, path = _fs(self.spark, f"{self.root}/{name}/{column}={value}")
        if fs.exists(path):
            fs.delete(path, True)

    def drop_batch(self, name: str, batch_id: int) -> None:
        """Take one load out of a table partitioned by load id."""
        self.drop_partition(name, "load_audit_id", batch_id)


def is_empty(df: DataFrame) -> bool:
    """Empty-input guard: looks at one row."""
    return df.isEmpty()


def read_by_pattern(spark: SparkSession, folder: str, pattern: str, recursive: bool = False) -> DataFrame:
    """Files of a folder (and its sub-folders) whose names match a glob pattern."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select("path", "length", "modificationTime", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
