"""Identifiers derived from natural keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfmark.functions.text import upper

# Start and length of the groups of a UUID.
_GROUPS = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))


def md5_uuid(col: Column | str) -> Column:
    """UUID text made from the MD5 digest; NULL stays NULL."""
    col = F.col(col) if isinstance(col, str) else col
    digest = F.md5(col)
    groups = [F.substring(digest, start, length) for start, length in _GROUPS]
    return F.when(col.isNotNull(), F.concat_ws("-", *groups))


def derive_user_id(user_uid: Column | str, site: Column | str) -> Column:
    """User id over (uid, site name), concatenated without separator, NULLs skipped."""
    return md5_uuid(F.concat_ws("", user_uid, site))


def derive_other_work_id(work_uid: Column | str, site: Column | str) -> Column:
    """Work id of another site, same construction as the user id."""
    return md5_uuid(F.concat_ws("", work_uid, site))


def short_form(col: Column | str) -> Column:
    """Trimmed, white space collapsed, upper case."""
    return upper(F.regexp_replace(F.trim(col), r"\s+", " "))


def dashed_title(col: Column | str) -> Column:
    """Title short form with every white-space run turned into a dash."""
    return F.regexp_replace(upper(F.trim(col)), r"\s+", "-")


def author_label(first: Column | str, last: Column | str) -> Column:
    """``LAST, FIRST`` in upper case; a missing part is left empty."""
    return F.concat_ws("", upper(last), F.lit(", "), upper(first))
