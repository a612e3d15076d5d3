"""ISBN conversions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def isbn10_to_13(isbn10: Column | str) -> Column:
    """EAN-13 text of an ISBN-10; NULL unless ten characters remain without dashes.

    The ISBN-10 check character is dropped, ``978`` put in front, and a new check
    digit computed with weights 1 and 3.
    """
    isbn10 = F.col(isbn10) if isinstance(isbn10, str) else isbn10
    bare = F.replace(isbn10.cast("string"), F.lit("-"), F.lit(""))
    body = F.concat(F.lit("978"), F.substring(bare, 1, 9))
    total = sum(
        (F.substring(body, i + 1, 1).try_cast("int") * (3 if i % 2 else 1) for i in range(12)),
        F.lit(0),
    )
    check = F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10))
    return F.when(F.length(bare) == 10, F.concat(body, check.cast("string")))
