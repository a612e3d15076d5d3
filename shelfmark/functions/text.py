"""Text expressions: clean-up, trigram sets, packed lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Separators of the packed list columns in the dump files.
TAG_SEPARATOR = "__&__"
COUNT_SEPARATOR = ";"
AUTHOR_SEPARATOR = ";"
MDS_SEPARATOR = "-->"


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def upper(col: Column | str) -> Column:
    """Upper case character by character: ``ß`` stays, it does not become ``SS``."""
    held = F.replace(_col(col), F.lit("ß"), F.lit("\ue000"))
    return F.replace(F.upper(held), F.lit("\ue000"), F.lit("ß"))


def split_literal(col: Column | str, separator: str) -> Column:
    """Split on a literal separator; an empty list text has no elements at all."""
    return F.split(F.nullif(_col(col), F.lit("")), r"\Q" + separator + r"\E")


def unix_lines(col: Column | str) -> Column:
    return F.replace(col, F.lit("\r\n"), F.lit("\n"))


def without_tabs(col: Column | str) -> Column:
    return F.replace(col, F.lit("\t"), F.lit(""))


def without_empty_rating(col: Column | str) -> Column:
    """Drop the empty parentheses a rating image leaves behind in review text."""
    return F.replace(col, F.lit(" (   )"), F.lit(""))


def count_of(col: Column | str) -> Column:
    """Integer out of text that may carry thousands commas and blanks."""
    return F.trim(F.replace(col, F.lit(","), F.lit(""))).try_cast("int")


def trigrams(col: Column | str) -> Column:
    """Set of character trigrams as packed longs.

    Words are runs of letters and digits, lower case, padded with two blanks before
    and one after. One look-ahead pass over the distinct words yields every window, so
    the cost is linear in the text length whatever the word lengths. A window is three code
    points of 21 bits each, hence the packing is exact.
    """
    words = F.array_distinct(F.split(F.lower(col), r"[^\p{L}\p{N}]+"))
    padded = F.concat(F.lit("  "), F.array_join(words, "   "), F.lit(" "))
    windows = F.array_distinct(
        F.regexp_extract_all(padded, F.lit(r"(?=(  [^ ]|.[^ ].))"), F.lit(1))
    )

    def pack(g: Column) -> Column:
        first = F.ascii(g).cast("long")
        second = F.ascii(F.substring(g, 2, 1)).cast("long")
        third = F.ascii(F.substring(g, 3, 1)).cast("long")
        return F.shiftleft(first, 42) + F.shiftleft(second, 21) + third

    return F.transform(windows, pack)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def jaccard(a: Column | str, b: Column | str, size_a: Column | str, size_b: Column | str) -> Column:
    """Shared elements over all elements of two sets of known sizes."""
    total = _col(size_a) + _col(size_b)
    ratio = let(F.size(F.array_intersect(a, b)), lambda shared: shared / (total - shared))
    return F.when(total > 0, ratio).otherwise(F.lit(0.0))


def trigram_similarity(a: Column | str, b: Column | str) -> Column:
    """Trigram similarity of two texts."""
    both = F.struct(trigrams(a).alias("a"), trigrams(b).alias("b"))
    return let(both, lambda p: jaccard(p["a"], p["b"], F.size(p["a"]), F.size(p["b"])))
