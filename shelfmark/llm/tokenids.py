"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A file holds consecutive documents in the order of doc_id::

    magic "SMTI", version, bytes per id (2 or 4), two zero bytes
    numbers of documents, ids, bytes of low bits, bytes of high bits, samples (8 bytes each)
    bitmap of the documents that have a doc_id, doc_ids (8 bytes each)
    Elias-Fano boundaries: low bits packed, high bits in unary, select samples
    ids

Numbers of the head are big-endian, all others little-endian. Where a file's ids start in
the whole set follows from the heads of the files before it.

The document ends ``e_0 <= e_1 <= …`` are split into ``l`` low bits each and the rest in
unary, ``l = floor(log2(ids / documents))``: about ``2 + l`` bits a document instead of a
64-bit offset. ``select(i)`` finds the i-th one of the unary part from the nearest sample,
and so the end of document i, without decoding the others.

Texts are range-partitioned by id, encoded where they lie and written as blocks of a
bounded number of ids. Spark's own committer writes the blocks, one file each, so a lost
executor or a repeated task leaves no half file, and any file system Spark reaches will do.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from shelfmark.llm.common import SPACES, chunks, prepared, ranges, saved, split_words, text_bytes, text_key
from shelfmark.session import shared_folder

MAGIC = b"SMTI"
VERSION = 1
BLOCK_IDS = 4 << 20  # ids after which a block is closed
SAMPLES = 256  # one select sample per so many documents
PREFIX = 16  # characters of a text that order rows of one id
CACHED_PARTS = 500_000  # distinct parts remembered by a worker


# Elias-Fano ------------------------------------------------------------------------------


class EliasFano:
    """A non-decreasing sequence of whole numbers up to ``universe``."""

    def __init__(self, n: int, universe: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.universe = n, universe
        self.bits = self.low_bits(n, universe)
        self.low, self.high = low, high
        self._low = np.frombuffer(low, dtype=np.uint8)
        self._high = np.frombuffer(high, dtype=np.uint8)
        self.samples = samples

    @staticmethod
    def low_bits(n: int, universe: int) -> int:
        return max(0, (universe // n).bit_length() - 1) if n else 0

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = cls.low_bits(n, universe)
        places = (values >> bits) + np.arange(n)
        unary = np.zeros((int(places[-1]) + 1 if n else 0), dtype=np.uint8)
        unary[places] = 1
        low = (values[:, None] >> np.arange(bits)) & 1
        return cls(
            n, universe, np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(),
            np.packbits(unary, bitorder="little").tobytes(), places[::SAMPLES].astype(np.uint64))

    def _low_part(self, i: np.ndarray) -> np.ndarray:
        at = i[:, None] * self.bits + np.arange(self.bits)
        bit = (self._low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (bit.astype(np.int64) << np.arange(self.bits)).sum(axis=1) if self.bits else np.zeros(len(i), dtype=np.int64)

    def select(self, i: int) -> int:
        """The i-th value: from the nearest sample on through the unary part."""
        place = int(self.samples[i // SAMPLES])
        left = i % SAMPLES
        while left:
            window = np.unpackbits(self._high[(place + 1) >> 3:((place + 1) >> 3) + 64], bitorder="little")
            window[:(place + 1) & 7] = 0
            ones = np.flatnonzero(window)
            took = min(left, len(ones))
            if took:
                place = ((place + 1) >> 3) * 8 + int(ones[took - 1])
                left -= took
            else:
                place = ((place + 1) >> 3) * 8 + len(window) - 1
        return ((place - i) << self.bits) | int(self._low_part(np.array([i]))[0])

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[:self.n]
        i = np.arange(self.n)
        return ((places - i) << self.bits) | self._low_part(i)


# Files -----------------------------------------------------------------------------------


def to_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """The bytes of a block; its ids' global start is added when it is read in its set."""
    ends = EliasFano.of(np.cumsum(lengths), len(ids))
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    head = np.array([len(doc_ids), len(ids), len(ends.low), len(ends.high), len(ends.samples)], dtype=">u8")
    return b"".join((
        MAGIC, bytes((VERSION, width, 0, 0)), head.tobytes(),
        np.packbits(known, bitorder="little").tobytes(),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        ends.low, ends.high, ends.samples.astype("<u8").tobytes(),
        ids.astype("<u2" if width == 2 else "<u4").tobytes()))


class TokenFile:
    """A block read back: documents by place, without a table of offsets."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC or data[4] != VERSION:
            raise ValueError("not a token-id file")
        width = data[5]
        n, n_ids, low, high, samples = (int(x) for x in np.frombuffer(data, dtype=">u8", count=5, offset=8))
        at = 48
        marks = -(-n // 8)
        known = np.unpackbits(np.frombuffer(data, dtype=np.uint8, count=marks, offset=at), bitorder="little")[:n]
        at += marks
        numbers = np.frombuffer(data, dtype="<i8", count=n, offset=at).tolist()
        self.doc_ids = [d if k else None for d, k in zip(numbers, known.tolist(), strict=True)]
        at += 8 * n
        low_part, high_part = data[at:at + low], data[at + low:at + low + high]
        at += low + high
        self.ends = EliasFano(n, n_ids, low_part, high_part, np.frombuffer(data, dtype="<u8", count=samples, offset=at))
        at += 8 * samples
        self.ids = np.frombuffer(data, dtype="<u2" if width == 2 else "<u4", count=n_ids, offset=at)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def document(self, place: int) -> np.ndarray:
        """Ids of one document, by two selects."""
        start = self.ends.select(place - 1) if place else 0
        return self.ids[start:self.ends.select(place)]


# Encoding --------------------------------------------------------------------------------


# Kinds of bytes between which no token of the word tokenizer can reach: ASCII letters and
# digits (1) against ASCII signs (2). The apostrophe takes part in contractions, and "<|>"
# in special tokens; they and all other bytes cut nothing.
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[[b for b in range(128) if chr(b).isalnum()]] = 1
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<|>"]] = 2
_SPECIAL = b"<|"


class WordEncoder:
    """Ids of texts for a tokenizer that ignores case and never joins what white space,
    or a change between letters and signs, parts.

    Distinct parts are encoded by the library, once while they are remembered, many in one
    call with a special token between them; a text's ids are its parts' ids in order. Texts
    with the beginning of a special token are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        if not special or not all(t.startswith(_SPECIAL.decode()) for t, _ in special):
            raise ValueError("the parts are put together with a special token that begins with <|")
        self.between, self.between_id = special[0]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.first = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _places(self, parts: list[bytes]) -> np.ndarray:
        """Place of each part in the memory, the new ones encoded first."""
        if len(self.known) > CACHED_PARTS:
            self._forget()
        new = [p for p in parts if p not in self.known]
        found = [self.ids]
        sizes = [self.sizes]
        for start in range(0, len(new), 256):
            some = new[start:start + 256]
            text = self.between.join([p.decode() for p in some])
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)
            cuts = np.flatnonzero(ids == self.between_id)
            sizes.append(np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1)
            found.append(np.delete(ids, cuts))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.ids, self.sizes = np.concatenate(found), np.concatenate(sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        known = self.known
        return np.fromiter((known[p] for p in parts), dtype=np.int64, count=len(parts))

    def _plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = split_words(column, SPACES, lower=True, kinds=_KINDS, loose=False)
        if not len(words):
            return np.zeros(0, dtype=np.int32), np.zeros(len(column), dtype=np.int64)
        place = self._places(words.values)[words.codes]
        sizes = self.sizes[place]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[ranges(self.first[place], sizes)], np.diff(total[words.bounds])

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk of texts, and how many each text has."""
        if _SPECIAL not in text_bytes(column)[0]:
            return self._plain(column)
        texts = column.to_pylist()
        odd = [i for i, t in enumerate(texts) if t and _SPECIAL.decode() in t]
        ids, counts = self._plain(pa.array([None if t and _SPECIAL.decode() in t else t for t in texts], pa.string()))
        at = np.concatenate([[0], np.cumsum(counts)])
        parts = [ids[at[i]:at[i + 1]] for i in range(len(texts))]
        for i in odd:
            parts[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, dtype=np.int32)
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One encoder per worker process, so that tasks go on with what former ones learnt."""
    return WordEncoder(path)


def _blocks(path: str, end_id: int, width: int):
    """Blocks of a task's documents: first doc_id, ids in the block, the file's bytes as text."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        doc_ids: list = []
        lengths: list[np.ndarray] = []
        held: list[np.ndarray] = []
        size, number = 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(held)
            data = to_file(doc_ids, np.concatenate(lengths), ids, width)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([data], pa.binary())], ["block", "data"])

        for part in chunks(batches, limit=6 << 20):
            ids, counts = encode(part.column("text"))
            ends = np.cumsum(counts)
            with_end = np.insert(ids, ends, end_id)
            doc_ids += part.column("doc_id").to_pylist()
            lengths.append(counts + 1)
            held.append(with_end.astype(np.uint16 if width == 2 else np.uint32))
            size += len(with_end)
            if size >= BLOCK_IDS:
                yield close()
                doc_ids, lengths, held, size, number = [], [], [], 0, number + 1
        if doc_ids:
            yield close()

    return write


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, vocabulary: int) -> None:
    """Write the ids of ``docs`` (doc_id, text) as block files into a new folder.

    Files are named ``part-<range>-…`` and sort in the order of doc_id; null ids come first.
    Rows of one id are in the order of the first ``PREFIX`` characters of their text, then of
    its hash, and of their place where they are equal: an id that very many rows share spreads
    over as many ranges as it needs. A null text has no ids but the end id.
    """
    spark = docs.sparkSession
    prepared(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.substring("text", 1, PREFIX), text_key(), F.col("place")]
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("place")
    blocks = ordered.mapInArrow(_blocks(tokenizer, end_id, width), "block int, data binary")
    # The text writer writes a string's bytes as they are and a line feed after them.
    blocks.select(F.col("data").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """part (the range), block and content of the files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).filter("length > 0")
    part = F.regexp_extract("path", r"part-([0-9]+)-[^/]*$", 1).cast("long")
    block = F.regexp_extract("path", r"c([0-9]+)\.txt$", 1).cast("long")
    return files.select(part.alias("part"), block.alias("block"), "content")


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c) for c in ("part", "block", "content"))
        for part, block, content in zip(*columns, strict=True):
            file = TokenFile(content.as_buffer().to_pybytes())
            ends = file.ends.all()
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            wide = file.ids.astype("<u4").tobytes()
            crc = [zlib.crc32(memoryview(wide)[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(part, len(ends)), pa.repeat(block, len(ends)), pa.array(file.doc_ids, pa.int64()),
                 pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())],
                ["part", "block", "doc_id", "start_here", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and crc32 of the ids, from the files.

    Every file is read once. Where its ids start follows from the sizes of the blocks before
    it in its range, and from the totals of the ranges before, one row for each of which
    comes to the driver; sizes of blocks stay on the executors.
    """
    prepared(spark)
    read = saved(token_files(spark, folder).mapInArrow(
        _documents, "part long, block long, doc_id long, start_here long, n_tokens long, ids_crc32 long"), "token-documents")
    sizes = read.groupBy("part", "block").agg(F.sum("n_tokens").alias("n_ids"))
    totals, before = [], 0
    for r in sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).orderBy("part").collect():  # one row per range
        totals.append((r["part"], before))
        before += r["n_ids"]
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_range = sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("in_range"))
    of_range = F.broadcast(spark.createDataFrame(totals, "part long, of_range long"))
    offsets = in_range.join(of_range, "part").select("part", "block", (F.col("in_range") + F.col("of_range")).alias("offset"))
    return read.join(offsets, ["part", "block"]).select(
        "doc_id", (F.col("start_here") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_report(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """Write ``docs`` as token files into the shared folder and report what is read back."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer, end_id, folder, vocabulary)
    return read_token_files(spark, folder)
