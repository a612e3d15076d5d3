"""Benchmark decontamination with an FM-index per training shard.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A phrase is a
window of ``length`` consecutive words of a benchmark item; an item of fewer words is one
phrase.

A shard is a bounded slice of the training texts as a worker reads it. Its index holds the
stretches that phrases can lie in: words outside the phrases' vocabulary cannot be part of
a match, so they end a stretch, and stretches shorter than the shortest phrase are left
out. Over the rest the shard builds a suffix array, its Burrows-Wheeler transform in a
wavelet tree with rank directories, and every ``SAMPLE``-th suffix position. All phrases
are searched backwards together; occurrences are located by stepping to a sampled
position; their spans are merged per document.

A document lies in one shard. Phrases are sent to the workers in blocks of at most ``block``
phrases. One block is searched while the texts pass by and nothing is shuffled. More blocks
are searched one after the other, each in a job of its own that writes the texts it hits; its
phrases are given up before the next block is sent, so a worker never holds two. What the
blocks found meets the texts by a digest of the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from shelfmark.llm.common import (
    NON_ALNUM, Words, chunks, packed, prepared, quoted, ranges, saved, split_words, with_fields,
)

LENGTH = 10
BLOCK = 200_000
SAMPLE = 8


# Phrases ------------------------------------------------------------------------------


def _find_phrases(length: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words = split_words(part.column("text"), NON_ALNUM, lower=True)
            items, phrases = [], []
            for row, item in enumerate(part.column("item_id").to_pylist()):
                a, b = words.bounds[row], words.bounds[row + 1]
                for s in range(a, max(b - length, a) + 1) if b > a else ():
                    items.append(item)
                    phrases.append(b" ".join(words.values[c] for c in words.codes[s:min(s + length, b)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string())], ["item_id", "phrase"])

    return find


def phrases_of(benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """Distinct phrases with the sorted distinct items that hold them: phrase, items.

    Item ids are taken as text; a null id is the item "" and a null text has no phrase.
    """
    prepared(benchmark.sparkSession)
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return (
        named.mapInArrow(_find_phrases(length), "item_id string, phrase string")
        .distinct()
        .groupBy("phrase")
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    )


class Phrases:
    """One block of phrases as arrays; the workers' copy of the query set."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        split = [phrase.encode().split(b" ") for phrase, _ in rows]
        self.codes: dict[bytes, int] = {}
        flat = [self.codes.setdefault(w, len(self.codes) + 1) for words in split for w in words]
        self.lengths = np.array([len(words) for words in split], dtype=np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.flat = np.array(flat, dtype=np.int64)
        self.items = [items for _, items in rows]
        self.shortest = int(self.lengths.min()) if rows else 0


# Index --------------------------------------------------------------------------------


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; suffixes that stand alone are not sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    ordered = text[order]
    new = np.ones(n, dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = heads  # rank: first place of the suffix's group
    reach = 1
    while True:
        alone = new.copy()
        alone[:-1] &= new[1:]
        open_places = np.flatnonzero(~alone)
        if not len(open_places):
            return order
        suffixes = order[open_places]
        after = suffixes + reach
        follow = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.lexsort((follow, heads[open_places]))
        suffixes, follow, group = suffixes[by], follow[by], heads[open_places][by]
        order[open_places] = suffixes
        new[open_places[1:]] |= (group[1:] == group[:-1]) & (follow[1:] != follow[:-1])
        heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[suffixes] = heads[open_places]
        reach *= 2


class WaveletTree:
    """Levelwise bit vectors of a sequence, most significant bit first, with rank counts."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.bits = bits
        self.zeros: list[int] = []
        self.ones: list[np.ndarray] = []
        for level in reversed(range(bits)):
            bit = (sequence >> level) & 1
            count = np.zeros(len(sequence) + 1, dtype=np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(sequence) - int(count[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(places), places
        for k, level in enumerate(reversed(range(self.bits))):
            one = ((symbols >> level) & 1).astype(bool)
            a, b = self.ones[k][low], self.ones[k][high]
            low = np.where(one, self.zeros[k] + a, low - a)
            high = np.where(one, self.zeros[k] + b, high - b)
        return high - low

    def symbol_and_rank(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before."""
        symbol = np.zeros_like(places)
        low, at = np.zeros_like(places), places
        for k in range(self.bits):
            ones = self.ones[k]
            one = ones[at + 1] > ones[at]
            symbol = symbol * 2 + one
            low = np.where(one, self.zeros[k] + ones[low], low - ones[low])
            at = np.where(one, self.zeros[k] + ones[at], at - ones[at])
        return symbol, at - low


class FMIndex:
    """Backward search and location over a sequence of symbols from 1; 0 separates stretches."""

    def __init__(self, text: np.ndarray, largest: int, sample: int = SAMPLE):
        text = np.append(text, 0)
        # Separators sort by place, so that no comparison runs on into the next stretch.
        ends = np.flatnonzero(text == 0)
        unique = text + (len(ends) - 1)
        unique[ends] = len(ends) - 1 - np.arange(len(ends))
        order = suffix_array(unique)
        before = text[order - 1]
        self.n = len(text)
        self.tree = WaveletTree(before, max(1, int(largest).bit_length()))
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])
        self.sampled = np.full(self.n, -1, dtype=np.int64)
        keep = (order % sample == 0) | (before == 0)
        self.sampled[keep] = order[keep]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array ranges of all phrases, each extended by one word to the left per step."""
        low = np.zeros(len(phrases.lengths), dtype=np.int64)
        high = np.full(len(phrases.lengths), self.n, dtype=np.int64)
        alive = np.arange(len(phrases.lengths))
        for step in range(1, int(phrases.lengths.max()) + 1):
            todo = alive[phrases.lengths[alive] >= step]
            symbol = phrases.flat[phrases.first[todo] + phrases.lengths[todo] - step]
            low[todo] = self.smaller[symbol] + self.tree.rank(symbol, low[todo])
            high[todo] = self.smaller[symbol] + self.tree.rank(symbol, high[todo])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(high, low)

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array places, by stepping to a sampled one."""
        out = np.empty(len(places), dtype=np.int64)
        todo, at, steps = np.arange(len(places)), places, 0
        while len(todo):
            found = self.sampled[at]
            done = found >= 0
            out[todo[done]] = found[done] + steps
            todo, at, steps = todo[~done], at[~done], steps + 1
            symbol, rank = self.tree.symbol_and_rank(at)
            at = self.smaller[symbol] + rank
        return out


# Search -------------------------------------------------------------------------------


def _stretches(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the stretches a phrase can lie in, each closed by a 0, and their word places."""
    of_value = np.fromiter((phrases.codes.get(v, 0) for v in words.values), dtype=np.int64, count=len(words.values))
    symbol = of_value[words.codes]
    known = np.zeros(len(symbol) + 2, dtype=bool)
    known[1:-1] = symbol > 0
    first = np.zeros(len(symbol) + 1, dtype=bool)
    first[words.bounds] = True
    begins = np.flatnonzero(known[1:-1] & (~known[:-2] | first[:-1]))
    stops = np.flatnonzero(known[1:-1] & (~known[2:] | first[1:])) + 1
    lengths = stops - begins
    long_enough = lengths >= max(phrases.shortest, 1)
    begins, lengths = begins[long_enough], lengths[long_enough]
    places = ranges(begins, lengths + 1)
    text = np.append(symbol, 0)[places]
    text[np.cumsum(lengths + 1) - 1] = 0
    return text, places


def _occurrences(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """First word and phrase of every occurrence in a shard."""
    nothing = np.zeros(0, dtype=np.int64)
    if not len(words) or not len(phrases.lengths):
        return nothing, nothing
    text, places = _stretches(words, phrases)
    if not len(text):
        return nothing, nothing
    index = FMIndex(text, len(phrases.codes))
    low, high = index.search(phrases)
    found = np.repeat(np.arange(len(low)), high - low)
    return places[index.locate(ranges(low, high - low))], found


_SPAN = StructType([StructField("first", IntegerType()), StructField("stop", IntegerType())])
_FOUND = (("n_words", LongType()), ("spans", ArrayType(_SPAN)), ("items", ArrayType(StringType())))
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))


def _search(phrases, columns: list[str]):
    """Per row: n_words, the merged spans (word places) and the items found."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Phrases = phrases.value
        for part in chunks(batches):
            words = split_words(part.column("text"), NON_ALNUM, lower=True)
            at, which = _occurrences(words, block)
            row = np.searchsorted(words.bounds, at, side="right") - 1
            spans: list[list] = [[] for _ in range(len(part))]
            items: list[list] = [[] for _ in range(len(part))]
            order = np.lexsort((at, row))
            at, which, row = at[order], which[order], row[order]
            edges = np.flatnonzero(np.diff(row, prepend=-1, append=-1)).tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                r = int(row[a])
                first = at[a:b] - words.bounds[r]
                spans[r] = _merged(zip(first.tolist(), (first + block.lengths[which[a:b]]).tolist(), strict=True))
                found: set[str] = set()
                for phrase in np.unique(which[a:b]).tolist():
                    found.update(block.items[phrase])
                items[r] = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(np.diff(words.bounds), pa.int64()),
                 pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
                [*columns, "n_words", "spans", "items"])

    return find


def _joined(columns: list[str]):
    """Per row: n_words, and the spans and items of all blocks merged."""

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words = split_words(part.column("text"), NON_ALNUM, lower=True, coded=False)
            spans = [_merged((s["first"], s["stop"]) for s in found or ()) for found in part.column("found").to_pylist()]
            items = pa.array([found or [] for found in part.column("items").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(np.diff(words.bounds), pa.int64()),
                 pa.array(spans, _SPANS), items],
                [*columns, "n_words", "spans", "items"])

    return join


def _search_blocks(docs: DataFrame, numbered: DataFrame, parts: int, columns: list[str]) -> DataFrame:
    """``docs`` (row, text) searched for one block of phrases after the other."""
    spark = docs.sparkSession
    hits = []
    texts = docs.select("text")
    for i in range(parts):
        phrases = _sent(numbered.filter(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == i))
        found = texts.mapInArrow(_search(phrases, ["text"]), with_fields(texts, ["text"], *_FOUND))
        hits.append(saved(
            found.filter(F.size("spans") > 0).select(F.md5("text").alias("digest"), "spans", "items")
            .dropDuplicates(["digest"]), "phrases-found"))
        phrases.destroy()
    every = spark.createDataFrame([], hits[0].schema)
    for part in hits:
        every = every.unionAll(part)
    merged = every.groupBy("digest").agg(
        F.flatten(F.collect_list("spans")).alias("found"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    marked = docs.join(merged, F.md5("text") == merged["digest"], "left").drop("digest")
    return marked.mapInArrow(_joined(columns), with_fields(docs, columns, *_FOUND))


def _sent(phrases: DataFrame):
    """A block of phrases, broadcast. A block is bounded by the caller."""
    rows = [(r["phrase"], r["items"]) for r in phrases.collect()]
    return phrases.sparkSession.sparkContext.broadcast(Phrases(rows))


def _merged(spans: Iterable[tuple[int, int]]) -> list[dict]:
    """Union of spans as maximal spans, in order."""
    out: list[dict] = []
    for first, stop in sorted(spans):
        if out and first <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], stop)
        else:
            out.append({"first": first, "stop": stop})
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, block: int = BLOCK, with_text: bool = True
) -> DataFrame:
    """``docs`` with n_words, spans (word places hit, merged) and items (sorted ids found).

    All columns of ``docs`` but those three names stay, ``text`` only if asked for. A null
    text has no words. Rows are judged one by one, so repeated rows and null ids need no
    rule. An empty benchmark hits nothing.
    """
    prepared(docs.sparkSession)
    out = packed(docs.drop("n_words", "spans", "items"), "text", without=("text",))
    columns = out.columns if with_text else ["row"]
    numbered = saved(phrases_of(benchmark, length), "phrases")
    parts = max(1, -(-numbered.count() // block))
    if parts == 1:
        out = out.mapInArrow(_search(_sent(numbered), columns), with_fields(out, columns, *_FOUND))
    else:
        out = _search_blocks(out, numbered, parts, columns)
    return out.select("row.*", *(c for c in out.columns if c != "row"))


def _cut(keep: list[str]):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            words = split_words(part.column("text"), NON_ALNUM, lower=True, coded=False)
            raw = part.column("text").to_pylist()
            starts_of = words.bounds
            out, base = [], 0
            for r, (text, spans) in enumerate(zip(raw, part.column("spans").to_pylist(), strict=True)):
                data = (text or "").encode()
                if spans:
                    pieces, last = [], 0
                    for span in spans:
                        pieces.append(data[last:words.starts[starts_of[r] + span["first"]] - base])
                        last = int(words.ends[starts_of[r] + span["stop"] - 1]) - base
                    pieces.append(data[last:])
                    out.append(b"\n".join(p.strip(b" ") for p in pieces).decode())
                else:
                    out.append(text)
                base += len(data)
            columns = [pa.array(out, pa.string()) if k == "text" else part.column(k) for k in keep]
            yield pa.RecordBatch.from_arrays(columns, keep)

    return cut


def without_benchmark(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """``docs`` (same columns) with the spans hit cut out of their texts.

    Each span gives way to a line break. Untouched texts come back as they are.
    """
    marked = contamination(packed(docs, "text"), benchmark, length, block)
    return marked.select("row", "text", "spans").mapInArrow(
        _cut(["row", "text"]), with_fields(marked, ["row", "text"])).select(
        *(F.col("text") if c == "text" else F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns))


def contamination_report(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = contamination(docs.select("doc_id", "text"), benchmark, length, with_text=False)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    return marked.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
