"""Delimited files: dumps to stage, reference lists, and the export of the star schema."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from shelfmark.functions.text import let
from shelfmark.schemas import LANGUAGE_REF, STAGED_TYPES, text_schema
from shelfmark.session import ship_package
from shelfmark.sources.tables import materialize


class UnknownColumns(ValueError):
    """The header names columns the staging table does not have."""


class TooManyBadRows(ValueError):
    """More rows could not be read than the load tolerates."""


def typed(df: DataFrame) -> DataFrame:
    """Staged text to the declared types; text that does not convert becomes NULL."""
    return df.withColumns(
        {c: F.col(c).try_cast(t) for c, t in STAGED_TYPES.items() if c in df.columns}
    )


# A file is never split and never shares a task with another one.
_ONE_TASK_A_FILE = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50)}


def _first_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task; the task ends with it and reads no further."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """Files by their first line.

    One task per file reads the file's beginning and stops; what comes back is a line per
    file. Files without a line have no rows and are left out.
    """
    ship_package(spark)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"))
    before = {key: spark.conf.get(key) for key in _ONE_TASK_A_FILE}
    for key, value in _ONE_TASK_A_FILE.items():
        spark.conf.set(key, value)
    try:
        found = lines.mapInArrow(_first_rows, lines.schema).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files: dict[str, list[str]] = {}
    for r in sorted(found):
        files.setdefault(r["header"], []).append(unquote(r["file"]))
    return files


def read_headered_dump(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Dumps whose header names their columns, each file its own, in any order.

    Quoted fields may hold line breaks. An empty field and ``\\N`` are NULL, a quoted
    empty field is empty text. Columns a file lacks are NULL. Files are read together
    with those of the same header.
    """
    rows = None
    for files in _headers(spark, path).values():
        df = (
            spark.read.option("header", True)
            .option("sep", "|")
            .option("multiLine", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("nullValue", "\\N")
            .csv(files)
        )
        unknown = [c for c in df.columns if c.lower() not in columns]
        if unknown:
            raise UnknownColumns(", ".join(unknown))
        present = {c.lower() for c in df.columns}
        part = df.select(*[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in columns])
        rows = part if rows is None else rows.union(part)
    return rows if rows is not None else spark.createDataFrame([], text_schema(tuple(columns)))


def read_plain_dump(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """A dump without header in a fixed column order, ``\\N`` for NULL, no quoting."""
    return spark.read.schema(text_schema(tuple(columns))).csv(
        path, sep="|", header=False, quote="", nullValue="\\N", emptyValue=""
    ).select(*columns)


def read_language_ref(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(text_schema(LANGUAGE_REF)).csv(path, sep="\t", header=False, quote="")


def load_language_ref(spark: SparkSession, path: str, stored: DataFrame | None) -> DataFrame:
    """The stored language table, read from the reference file only while it is empty."""
    if stored is not None and not stored.isEmpty():
        return stored
    return read_language_ref(spark, path)


# The character put for the delimiter inside exported texts.
EXPORT_REPLACEMENTS = {
    "dim_book": {"title_ori": " ", "english_title": " ", "french_title": " "},
    "dim_tag": {"tag_name": " "},
    "dim_author": {"name": ","},
    "dim_reviewer": {"username": " "},
    "review": {"review": " "},
}


def _escaped(value: Column) -> Column:
    for plain, coded in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("|", "\\|")):
        value = F.replace(value, F.lit(plain), F.lit(coded))
    return value


def _unescaped(value: Column) -> Column:
    """Codes undone from left to right in one pass: a code is a backslash and the character after it."""
    def plain(part: Column) -> Column:
        out = F.when(part == "\\n", "\n").when(part == "\\r", "\r").when(part == "\\t", "\t")
        coded = F.startswith(part, F.lit("\\")) & (F.length(part) > 1)
        return out.when(coded, F.substr(part, F.lit(2))).otherwise(part)

    parts = F.regexp_extract_all(value, F.lit(r"(?s)(\\.|[^\\]++|\\)"), F.lit(1))
    return F.when(F.contains(value, F.lit("\\")), F.array_join(F.transform(parts, plain), "")).otherwise(value)


def export_delimited(
    df: DataFrame, path: str, replacements: Mapping[str, str] | None = None, compress: bool = False
) -> None:
    """Write ``|``-delimited text lines, one part per task: NULL as ``\\N``, line breaks escaped."""
    replacements = replacements or {}
    cells = []
    for name, kind in df.dtypes:
        value = F.col(name).cast("string")
        if name in replacements:
            value = F.replace(value, F.lit("|"), F.lit(replacements[name]))
        if kind == "string":
            value = _escaped(value)
        cells.append(F.coalesce(value, F.lit("\\N")))
    lines = df.select(F.concat_ws("|", *cells).alias("value"))
    lines.write.option("compression", "gzip" if compress else "none").text(path)


# What is kept of a line that could not be read: where it stands, what was wrong, and the line.
REJECT = "source string, block bigint, field string, reason string, line string"
WRONG_COUNT, WRONG_VALUE = "number of fields", "value"


def read_with_rejects(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame, int]:
    """Rows of an export, the lines that are none (REJECT), and how many those are.

    A line is rejected when it has another number of fields, or for the first field that
    does not convert. ``source`` is its file and ``block`` the byte at which the part of the
    file begins that it was read with. One pass writes rows and rejects to an intermediate
    table and counts the rejects on the way.
    """
    fields = StructType.fromDDL(schema).fields
    # Fields end at a delimiter no backslash stands before.
    cells = F.regexp_extract_all(
        F.concat(F.col("value"), F.lit("|")), F.lit(r"((?:[^\\|]++|\\.)*+)\|"), F.lit(1)
    )

    def row(found: Column) -> Column:
        out, unread = [], []
        for i, field in enumerate(fields):
            cell = F.nullif(F.get(found, F.lit(i)), F.lit("\\N"))
            value = _unescaped(cell) if field.dataType == StringType() else cell.try_cast(field.dataType)
            out.append(value.alias(field.name))
            unread.append(F.when(cell.isNotNull() & value.isNull(), F.lit(field.name)))
        wrong_count = F.size(found) != len(fields)
        first = F.when(~wrong_count, F.coalesce(*unread, F.lit(None).cast("string")))
        reason = F.when(wrong_count, WRONG_COUNT).when(first.isNotNull(), WRONG_VALUE)
        reject = F.struct(
            F.col("file_path").alias("source"), F.col("file_block_start").alias("block"), first.alias("field"),
            reason.alias("reason"), F.col("value").alias("line"))
        return F.struct(F.struct(*out).alias("row"), F.when(reason.isNotNull(), reject).alias("reject"))

    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    observed = Observation()
    # Unpacked by a generator, so that each line is taken apart once.
    read = materialize(
        lines.select(F.inline(F.array(let(cells, row)))).observe(observed, F.count("reject").alias("rejects")), "read-back")
    return (
        read.filter("reject is null").select("row.*"),
        read.filter("reject is not null").select("reject.*"),
        observed.get["rejects"],
    )


def read_tolerant(spark: SparkSession, path: str, schema: str, max_errors: int = 100) -> DataFrame:
    """Read an export back; unreadable rows are dropped unless they exceed the limit."""
    rows, _, bad = read_with_rejects(spark, path, schema)
    if bad > max_errors:
        raise TooManyBadRows(f"{bad} rows, {max_errors} tolerated")
    return rows
