"""Fill-in-the-middle: cut a text at two ranks and move its middle to the end.

A text is a sequence of units (code points, or what a pattern matches). Over the units lies
an indexable skip list. Its lowest lane holds every unit; each express lane holds about a
quarter of the units of the lane below and, for the way from one of its nodes to the next,
two widths: how many units and how many code points are passed. To find a rank one starts
at the head of the highest lane, goes on while the units passed stay within the rank, and
then goes down a lane; the code points passed along the way are the place of the cut.

Which units stand on a lane follows from their number alone, so lists need no random state
and a repeated task builds the same ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType

from shelfmark.llm.common import chunks, mixed, packed, prepared, with_fields

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PERCENT = 90  # of the texts are cut
SUFFIX_FIRST = 20  # percent of those that begin with the suffix
PLAIN, PSM, SPM = "plain", "psm", "spm"


class SkipList:
    """Indexable skip list over units of the given numbers of code points."""

    def __init__(self, chars: np.ndarray, heights: np.ndarray):
        """``heights[i]``: how many express lanes unit i stands on; the first one stands on all."""
        self.units = len(chars)
        # A lane: units and code points from each node to the next, and each node's place in the lane below.
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        before = np.zeros(self.units + 1, dtype=np.int64)
        np.cumsum(chars, out=before[1:])
        nodes, below = np.arange(self.units), np.arange(self.units)
        while len(nodes):
            ends = np.append(nodes, self.units)
            self.lanes.append((np.diff(ends), np.diff(before[ends]), below))
            if len(nodes) == 1:
                break
            up = heights[nodes] >= len(self.lanes)
            up[0] = True
            below = np.flatnonzero(up)
            nodes = nodes[below]

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank (from 0); a rank past the last is the end."""
        node = passed = chars = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            unit_width, char_width, below = self.lanes[level]
            while node < len(unit_width) and passed + unit_width[node] <= rank:
                passed += int(unit_width[node])
                chars += int(char_width[node])
                node += 1
            if level:
                node = int(below[node]) if node < len(below) else len(self.lanes[level - 1][0])
        return chars


def heights_of(n: int) -> np.ndarray:
    """Express lanes of units 0 to n - 1: each further lane with a chance of one in four."""
    bits = mixed(np.arange(1, n + 1, dtype=np.uint64))
    lowest = (bits & (~bits + np.uint64(1))).astype(np.float64)  # the lowest bit that is set
    return (np.log2(np.maximum(lowest, 1.0)) // 2).astype(np.int8)


def unit_widths(text: str, pattern: re.Pattern | None) -> np.ndarray:
    """Code points of each unit: of the pattern's matches from left to right; what lies between them, each for itself."""
    if pattern is None:
        return np.ones(len(text), dtype=np.int64)
    widths: list[int] = []
    at = 0
    for match in pattern.finditer(text):
        if match.end() > match.start():
            widths += [1] * (match.start() - at) + [match.end() - match.start()]
            at = match.end()
    return np.array(widths + [1] * (len(text) - at), dtype=np.int64)


def _cut(columns: list[str], signs: tuple[str, str, str], unit: str | None, percent: int, suffix_first: int):
    prefix, suffix, middle = signs

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = None if unit is None else re.compile(unit)
        heights = heights_of(0)
        for part in chunks(batches):
            found: list[tuple] = []
            for text, draws in zip(part.column("text").to_pylist(), part.column("draws").to_pylist(), strict=True):
                text = text or ""
                widths = unit_widths(text, pattern)
                n = len(widths)
                if not text or any(s in text for s in signs) or draws[2] % 100 >= percent:
                    found.append((n, PLAIN, None, None, text))
                    continue
                if n > len(heights):
                    heights = heights_of(2 * n)
                units = SkipList(widths, heights)
                a, b = (units.place(rank) for rank in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
                if draws[3] % 100 < suffix_first:
                    form, out = SPM, (suffix, text[b:], prefix, text[:a], middle, text[a:b])
                else:
                    form, out = PSM, (prefix, text[:a], suffix, text[b:], middle, text[a:b])
                found.append((n, form, a, b - a, "".join(out)))
            made = [pa.array(c, t) for c, t in zip(
                zip(*found, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), *made],
                [*columns, "n", "form", "prefix_chars", "middle_chars", "output"])

    return cut


def _draws(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers drawn from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)))


def _checked(signs: tuple[str, str, str]) -> tuple[str, str, str]:
    """Signs that can be found again: the first character of each occurs in them nowhere else."""
    if len(set(signs)) < 3 or any(s[:1] in t[1:] for s in signs for t in signs) or not all(signs):
        raise ValueError("the first character of a sign must not occur again within the signs")
    return signs


def infilled(
    docs: DataFrame, signs: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE), unit: str | None = None,
    percent: int = PERCENT, suffix_first: int = SUFFIX_FIRST, seed: int = SEED,
) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars and output; columns of those names are replaced.

    ``unit`` is a pattern of what may not be cut; None takes code points. The cuts and the
    form are drawn from the id, so a row gives the same output in every run. Form plain
    leaves the text as it is: empty and null texts, texts that hold a sign, and those the
    draw leaves out; their two counts are null. Rows are cut one by one: repeated rows give
    equal outputs, rows without an id draw as an empty id does, and an empty table gives none.
    """
    prepared(docs.sparkSession)
    made = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = docs.drop(*made)
    rows = packed(kept, _draws(F.col("doc_id"), seed).alias("draws"), "text")
    layout = with_fields(
        rows, ["row"], ("n", LongType()), ("form", StringType()), ("prefix_chars", LongType()),
        ("middle_chars", LongType()), ("output", StringType()))
    out = rows.mapInArrow(_cut(["row"], _checked(signs), unit, percent, suffix_first), layout)
    return out.select("row.*", *made)


def restored(output: Column, form: Column, signs: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text an output was made of, from the output and its form alone."""
    prefix, suffix, middle = signs

    def between(start: Column, sign: str, stop: Column) -> Column:
        return F.substring(output, start + len(sign), stop - start - len(sign))

    p, s, m = (F.instr(output, sign) for sign in (prefix, suffix, middle))
    end = F.char_length(output) + 1
    last = between(m, middle, end)
    return (
        F.when(form == PSM, F.concat(between(p, prefix, s), last, between(s, suffix, m)))
        .when(form == SPM, F.concat(between(p, prefix, m), last, between(s, suffix, p)))
        .otherwise(output)
    )


def infilling_report(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and digests of the output and of the text rebuilt from it."""
    made = infilled(docs.select("doc_id", "text"))
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"))
