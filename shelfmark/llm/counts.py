"""Token counts from a digest cache.

A count belongs to a content and a tokenizer. The content's digest is that of its normal
form, so texts the tokenizer cannot tell apart share a count; the tokenizer's digest covers
its file, its library's version and the rule of normal forms, so a new version never meets
old counts. Both together are the key of the cache, a parquet table partitioned by
tokenizer.

Digests are reduced to distinct ones and joined with the cache. What misses is encoded once
per distinct content, appended to the cache, and the counts are joined back. Texts leave
their partition only for the misses: where they are few, their digests (a checked number)
go to the texts; otherwise texts are shuffled, equal ones merged beforehand.

Under a byte-level tokenizer a text's count is the sum of those of its words, cut where no
token reaches across. The library encodes each distinct word once while it is remembered;
texts of mostly unknown words go to it whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType

from shelfmark.llm.common import chunks, packed, prepared, saved, text_bytes
from shelfmark.session import shared_folder
from shelfmark.sources.tables import _fs

LIMIT = 512
SENT_DIGESTS = 200_000  # misses whose digests (32 bytes each) may be sent to every worker
SLICE_BYTES = 4 << 20  # of text counted at a time
LONG = 1 << 20  # code points after which a text is encoded in parts
KNOWN_WORDS = 1_000_000  # distinct words whose counts a worker remembers
WORD_BYTES = 64  # of a remembered word at most
NEW_WORDS = 0.25  # share of unknown words beyond which texts are encoded whole, which is cheaper then
RULE = "1"  # of normal forms; part of a tokenizer's digest


# Tokenizers ------------------------------------------------------------------------------


# Kinds of normalizers that look at nothing but the text they are given.
_PLAIN_NORMALIZERS = {"Lowercase", "NFC", "NFD", "NFKC", "NFKD", "StripAccents", "Replace"}


def _kinds(part: dict | None) -> set[str]:
    """Types of a tokenizer's component and of those it is put together from."""
    if part is None:
        return set()
    inner = part.get("normalizers") or part.get("pretokenizers") or []
    return {part["type"]} - {"Sequence"} | {k for p in inner for k in _kinds(p)}


class JsonTokenizer:
    """A tokenizer of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import json

        import tokenizers

        self.library = f"tokenizers {tokenizers.__version__}"
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        layout = json.loads(Path(path).read_text())
        before = _kinds(layout.get("pre_tokenizer"))
        self._added = [t["content"] for t in layout.get("added_tokens") or []]
        normalizers = _kinds(layout.get("normalizer"))
        # A text's normal form stands for it where nothing but the normalizer comes before the split.
        self.normalizes = bool(normalizers) and normalizers <= _PLAIN_NORMALIZERS and "Metaspace" not in before
        # The byte-level split never joins a word to the space after it, so a long text may be cut there.
        splits = [p for p in [layout.get("pre_tokenizer") or {}] if p.get("type") == "ByteLevel" and p.get("use_regex", True)]
        self.cuts = bool(splits) and not normalizers and not any(
            " " in t["content"] or t.get("lstrip") or t.get("rstrip") or t.get("single_word")
            for t in layout.get("added_tokens") or [])
        self.prefixed = bool(splits) and splits[0].get("add_prefix_space", True)
        # No word begins inside an added token or beside one of its signs.
        self._word_kinds = _KINDS.copy()
        self._word_kinds[[b for t in self._added for b in t.encode() if _KINDS[b] == 2]] = 0
        self._known: dict[bytes, int] = {}

    def normal(self, text: str) -> tuple[bool, str]:
        """Whether the normal form differs in kind from the text, and the form itself.

        Texts with the string of an added token stand for themselves: such strings are
        looked for before the text is normalised.
        """
        if not self.normalizes or any(t in text for t in self._added):
            return False, text
        return True, self.tokenizer.normalizer.normalize_str(text)

    def counts(self, texts: list[str]) -> list[int]:
        if not self.cuts or self.prefixed:
            return self._encoded(texts)
        return self._by_words(texts)

    def _by_words(self, texts: list[str]) -> list[int]:
        """How many tokens each text has, as the sum of its words'."""
        data, offsets = text_bytes(pa.array(texts, pa.large_string()))
        raw = np.frombuffer(data, dtype=np.uint8)
        starts = np.flatnonzero(_word_starts(raw, offsets, self._word_kinds))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        if len(self._known) > KNOWN_WORDS:
            self._known.clear()
        values, known = words.dictionary.to_pylist(), self._known
        new = [w for w in values if w not in known]
        if len(new) > NEW_WORDS * len(starts):
            return self._encoded(texts)
        fresh = dict(zip(new, self._encoded([w.decode() for w in new]), strict=True))
        sizes = np.fromiter((fresh[w] if w in fresh else known[w] for w in values), np.int64, len(values))
        known.update((w, n) for w, n in fresh.items() if len(w) <= WORD_BYTES)
        total = np.concatenate([[0], np.cumsum(sizes[words.indices.to_numpy()])])
        return np.diff(total[np.searchsorted(starts, offsets)]).tolist()

    def _encoded(self, texts: list[str]) -> list[int]:
        """How many ids the library gives each text."""
        parts = [self._parts(t) for t in texts]
        flat = [p for some in parts for p in some]
        sizes = [len(e) for e in self.tokenizer.encode_batch_fast(flat, add_special_tokens=False)]
        if len(flat) == len(texts):
            return sizes
        out, at = [], 0
        for some in parts:
            out.append(sum(sizes[at:at + len(some)]))
            at += len(some)
        return out

    def _parts(self, text: str) -> list[str]:
        if len(text) <= LONG or not self.cuts or self.prefixed:
            return [text]
        cuts, at = [0], LONG
        while found := _CUT.search(text, at):
            cuts.append(found.start() + 1)
            at = found.start() + 1 + LONG
        return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


# Between a letter or digit and a space before a letter.
_CUT = re.compile(r"[^\W_] (?=[^\W\d_])")

# ASCII letters and digits (1) and signs (2); the apostrophe, which contractions begin with, is neither.
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[[b for b in range(128) if chr(b).isalnum()]] = 1
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = 2
# Visible ASCII; first bytes of characters of two bytes that are no white space.
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[33:127] = True
_PAIRED = np.zeros(256, dtype=bool)
_PAIRED[0xC3:0xE0] = True


def _word_starts(raw: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Marks where words begin that the byte-level split never joins to what is before.

    That is at the begin of a text, at a single space between two visible characters, which
    is split off with what follows it, and between a letter or digit and a sign.
    """
    begins = np.zeros(len(raw) + 1, dtype=bool)
    begins[offsets] = True
    begins = begins[:len(raw)]
    if len(raw) < 2:
        return begins
    kind = kinds[raw]
    begins[1:] |= (kind[1:] ^ kind[:-1]) == 3
    before, after = _VISIBLE[raw], _VISIBLE[raw] | _PAIRED[raw]
    before[1:] |= _PAIRED[raw[:-1]]
    begins[1:-1] |= (raw[1:-1] == 32) & before[:-2] & after[2:]
    return begins


class PieceTokenizer:
    """A tokenizer of the sentencepiece library; texts stand for themselves."""

    normalizes = False

    def __init__(self, path: str):
        import sentencepiece

        self.library = f"sentencepiece {sentencepiece.__version__}"
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)

    def normal(self, text: str) -> tuple[bool, str]:
        return False, text

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.processor.encode(texts, num_threads=1)]


@lru_cache(maxsize=4)
def tokenizer_of(path: str) -> JsonTokenizer | PieceTokenizer:
    """The tokenizer of a file, by its ending; one per worker process."""
    return PieceTokenizer(path) if path.endswith(".model") else JsonTokenizer(path)


def tokenizer_digest(path: str) -> str:
    """Digest of a tokenizer's file, library and rule of normal forms."""
    head = f"{tokenizer_of(path).library}\n{RULE}\n".encode()
    return hashlib.sha256(head + Path(path).read_bytes()).hexdigest()


# Digests ---------------------------------------------------------------------------------


def _normal_digests(path: str):
    def digests(texts: pa.Array) -> pa.Array:
        tokenizer = tokenizer_of(path)

        def one(text: str) -> bytes:
            kind, form = tokenizer.normal(text)
            return hashlib.sha256((b"n" if kind else b"t") + form.encode()).digest()

        return pa.array([one(t) for t in texts.to_pylist()], pa.binary())

    return F.arrow_udf(digests, BinaryType())


def content_digest(path: str, text: Column) -> Column:
    """SHA-256 of a text's normal form under a tokenizer; null is an empty text."""
    text = F.coalesce(text, F.lit(""))
    if tokenizer_of(path).normalizes:
        return _normal_digests(path)(text)
    return F.unhex(F.sha2(F.concat(F.lit("t"), text), 256))


# Cache -----------------------------------------------------------------------------------


class CountCache:
    """Counts by tokenizer and content digest, in a folder that is only ever appended to.

    An append is one committed job; what a failed one leaves is never a part of it. Two jobs
    that miss the same content at once both append its count: they agree, and a reader
    takes one.
    """

    LAYOUT = "digest binary, n_tokens long, tokenizer string"

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, tokenizer: str) -> DataFrame:
        """digest and n_tokens, one row per digest known for a tokenizer."""
        fs, path = _fs(self.spark, self.folder)
        if not fs.exists(path):
            return self.spark.createDataFrame([], "digest binary, n_tokens long")
        known = self.spark.read.schema(self.LAYOUT).parquet(self.folder)
        return known.filter(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, tokenizer: str, counts: DataFrame) -> None:
        rows = counts.select("digest", "n_tokens", F.lit(tokenizer).alias("tokenizer"))
        rows.write.mode("append").partitionBy("tokenizer").parquet(self.folder)


def _encode(path: str):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(path)
        for part in chunks(batches, limit=SLICE_BYTES):
            counts = tokenizer.counts(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return encode


def fill(texts: DataFrame, tokenizer: str, cache: CountCache, sent: int = SENT_DIGESTS) -> int:
    """Encode the distinct contents of ``texts`` (digest, text) that the cache lacks; how many they were."""
    version = tokenizer_digest(tokenizer)
    asked = texts.select("digest").distinct()
    missing = saved(asked.join(cache.read(version), "digest", "left_anti"), "missing-digests")
    n = missing.count()
    if not n:
        return 0
    few = n <= sent
    rows = texts.join(F.broadcast(missing), "digest", "left_semi") if few else texts
    # Copies are merged within each task before any text is shuffled.
    distinct = rows.groupBy("digest").agg(F.first("text").alias("text"))
    if not few:
        distinct = distinct.join(missing, "digest", "left_semi")
    cache.append(version, distinct.mapInArrow(_encode(tokenizer), "digest binary, n_tokens long"))
    return n


def token_counts(docs: DataFrame, tokenizer: str, cache: CountCache, sent: int = SENT_DIGESTS) -> DataFrame:
    """``docs`` with n_tokens; a column of that name is replaced.

    Tokens are what the library gives without begin, end or added special tokens; strings
    of special tokens inside a text are handled as is its default. A null text is empty.
    Counts belong to contents, so repeated rows, null ids and ties need no rule. An empty
    table gives no rows and leaves the cache as it is.
    """
    prepared(docs.sparkSession)
    kept = docs.drop("n_tokens")
    text = F.coalesce("text", F.lit(""))
    fill(kept.select(content_digest(tokenizer, F.col("text")).alias("digest"), text.alias("text")), tokenizer, cache, sent)
    rows = packed(kept, content_digest(tokenizer, F.col("text")).alias("digest"))
    known = cache.read(tokenizer_digest(tokenizer))
    return rows.join(known, "digest", "left").select("row.*", "n_tokens")


def count_report(docs: DataFrame, tokenizer: str, cache: CountCache, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``."""
    spark = docs.sparkSession
    prepared(spark)
    digest = content_digest(tokenizer, F.col("text"))
    fill(docs.select(digest.alias("digest"), F.coalesce("text", F.lit("")).alias("text")), tokenizer, cache)
    narrow = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), digest.alias("digest"))
    known = cache.read(tokenizer_digest(tokenizer))
    return narrow.join(known, "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def own_cache(spark, name: str) -> CountCache:
    """A cache of its own in the shared folder."""
    import uuid

    return CountCache(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
