"""Helpers shared by the corpus operators: tables, bounded text chunks, words as arrays."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from shelfmark.session import ship_package
from shelfmark.sources.tables import materialize

# Bytes of text one worker turns into arrays at a time; a longer text is a chunk alone.
CHUNK_BYTES = 2 << 20

# Gives freed memory back to the system, where the C library has it (glibc).
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
# Everything in ASCII but digits and lower-case letters.
NON_ALNUM = np.zeros(256, dtype=bool)
NON_ALNUM[:128] = True
NON_ALNUM[48:58] = False
NON_ALNUM[97:123] = False


def prepared(spark: SparkSession) -> None:
    """Ship this package to the workers and keep the batches they get small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a step's result to the shared folder and read it back.

    The step's shuffle files go as soon as it is written: nothing reads them again, and a
    job of several steps would otherwise hold those of all its steps at once.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN_UP, "false")
    conf.set(_CLEAN_UP, "true")
    try:
        out = materialize(df, name)
    finally:
        conf.set(_CLEAN_UP, before)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def quoted(name: str) -> str:
    """A column name as it is written in an expression, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, *beside: str | Column, without: tuple[str, ...] = ()) -> DataFrame:
    """All columns of ``df`` but those of ``without`` as one struct column row, and the columns ``beside`` it.

    Steps carry a row whole and untouched through a worker this way: none of its names can
    clash with those of a step.
    """
    kept = [c for c in df.columns if c not in without]
    return df.select(F.struct(*(F.col(quoted(c)) for c in kept)).alias("row"), *beside)


def with_fields(df: DataFrame, columns: list[str], *more: tuple[str, DataType]) -> StructType:
    """The layout of some columns of ``df`` with further fields after them."""
    return StructType([StructField(c, df.schema[c].dataType) for c in columns] + [StructField(*m) for m in more])


def text_key(column: str = "text") -> Column:
    """64-bit hash of a text; beside doc_id it tells rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, or one row.

    Memory that the last slice needed goes back to the system before the next one is made,
    so a worker never holds more than one slice's arrays.
    """
    pool = pa.default_memory_pool()
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
            pool.release_unused()
            if _TRIM is not None:
                _TRIM(0)


def text_bytes(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts' UTF-8 bytes end to end and each text's start (one more for the end); null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if data is not None else b""
    return whole, offsets - offsets[0]


@dataclass
class Words:
    """The words of a chunk of texts, in order.

    ``codes[i]`` is the place of word i in ``values`` (the distinct words); text t has the
    words ``bounds[t]`` to ``bounds[t + 1]``; word i is ``data[starts[i]:ends[i]]``.
    """

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    codes: np.ndarray | None = None
    values: list[bytes] | None = None

    def __len__(self) -> int:
        return len(self.starts)


def split_words(
    column: pa.Array, separators: np.ndarray, lower: bool = False, coded: bool = True,
    kinds: np.ndarray | None = None, loose: bool = True,
) -> Words:
    """Maximal runs of bytes that are no separators (all separators are ASCII).

    ``lower``: A-Z lower-cased first, unless ``loose`` is off and the next byte is not
    ASCII, where a combining mark could follow. ``kinds``: a number per byte; a run is cut
    as well between neighbours of kinds 1 and 2.
    """
    data, offsets = text_bytes(column)
    if lower and loose:
        data = data.translate(UPPER_TO_LOWER)
    raw = np.frombuffer(data, dtype=np.uint8)
    if lower and not loose:
        upper = (raw >= 65) & (raw <= 90)
        upper[:-1] &= raw[1:] < 128
        raw = raw + upper.astype(np.uint8) * np.uint8(32)
        data = raw.tobytes()
    inside = ~separators[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    if kinds is not None:
        kind = kinds[raw]
        first[1:-1] |= (kind[1:] ^ kind[:-1]) == 3
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    words = Words(data, starts, ends, np.searchsorted(starts, offsets))
    if coded:
        lengths = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(ends - starts, out=lengths[1:])
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(raw[inside].tobytes())]
        )
        coded_words = packed.dictionary_encode()
        words.codes = coded_words.indices.to_numpy()
        words.values = coded_words.dictionary.to_pylist()
    return words


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``starts[i], starts[i] + 1, …`` with ``lengths[i]`` members each."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, dtype=np.int64) - before, lengths)
