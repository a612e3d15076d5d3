"""Normalisation of raw review fields, one expression per field for all sites."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfmark.functions.text import let

# Logical names of the sites, ids 1 to 5 in this order.
LIBRARYTHING = "librarything"
GOODREADS = "goodreads"
CRITIQUESLIBRES = "critiqueslibres"
BABELIO = "babelio"
AMAZON = "amazon.com"
SITES = (LIBRARYTHING, GOODREADS, CRITIQUESLIBRES, BABELIO, AMAZON)

# French month names in calendar order.
FRENCH_MONTHS = (
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
)

# Fixed value: stands for reviewers without a profile.
ANONYMOUS = "A customer"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def found(col: Column, pattern: str, group: int = 1) -> Column:
    """Matched group, NULL (not empty text) when the pattern is absent."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def parsed_rating(site: Column | str, rating: Column | str) -> Column:
    """Rating on the scale 0 to 10."""
    site, raw = _col(site), _col(rating)
    image = found(raw, r"ss(\d+)\.gif").try_cast("int")
    stars = raw.try_cast("int")
    out_of = found(raw, r"^(.*?) ?out of").try_cast("double")
    slashed = found(raw, r"([0-9.]+)(?:/.*)?$").try_cast("double")
    named = found(raw, r"^(\d+) ").try_cast("int")
    return (
        F.when(site == LIBRARYTHING, image)
        .when(site == GOODREADS, F.when(stars > 0, stars * 2))
        .when(site == AMAZON, (out_of * 2).cast("int"))
        # No star at all means a rating of zero here.
        .when(site == BABELIO, F.when(raw.isNull(), 0).otherwise(F.floor(slashed).cast("int") * 2))
        .when(site == CRITIQUESLIBRES, named)
    )


def french_date(col: Column | str) -> Column:
    """Date out of text ending in ``22 février 2016``."""
    parts = F.split(F.regexp_extract(_col(col), r"(\d{1,2} \p{L}+ \d{4})$", 1), " ")

    def date(p: Column) -> Column:
        number = F.array_position(F.array(*[F.lit(m) for m in FRENCH_MONTHS]), F.get(p, F.lit(1)))
        text = F.concat_ws("-", F.get(p, F.lit(2)), number.cast("string"), F.get(p, F.lit(0)))
        return F.try_to_timestamp(text, F.lit("y-M-d")).cast("date")

    return let(parts, date)


def parsed_date(site: Column | str, raw: Column | str) -> Column:
    """Review date; NULL where the text is no date."""
    site, raw = _col(site), _col(raw)
    short = F.try_to_timestamp(raw, F.lit("MMM d, yyyy")).cast("date")
    long = F.try_to_timestamp(raw, F.lit("'on' MMMM d, yyyy")).cast("date")
    return (
        F.when(site.isin(LIBRARYTHING, GOODREADS), short)
        .when(site == AMAZON, long)
        .when(site.isin(BABELIO, CRITIQUESLIBRES), french_date(raw))
    )


def _votes(raw: Column) -> Column:
    """Helpful votes text without commas, NULL unless it speaks of people."""
    bare = F.replace(raw, F.lit(","), F.lit(""))
    return F.when(F.instr(bare, "people") > 1, bare)


def parsed_likes(site: Column | str, raw: Column | str) -> Column:
    site, raw = _col(site), _col(raw)
    return (
        F.when(site.isin(LIBRARYTHING, BABELIO), F.trim(raw).try_cast("int"))
        .when(site == GOODREADS, found(raw, r"^\s*([\d]+) *like").try_cast("int"))
        .when(site == AMAZON, found(_votes(raw), r"^\s*(\d+)").try_cast("int"))
    )


def parsed_dislikes(site: Column | str, raw: Column | str) -> Column:
    """Those who voted but not for the review; known from ``3 of 5 people`` only."""
    site, votes = _col(site), _votes(_col(raw))
    liked = found(votes, r"^\s*(\d+) of ").try_cast("int")
    voted = found(votes, r" of (\d+) *people").try_cast("int")
    return F.when(site == AMAZON, voted - liked)


def user_uid(site: Column | str, link: Column | str, username: Column | str) -> Column:
    """User id of the site, out of the link to the profile."""
    site, link, username = _col(site), _col(link), _col(username)
    return (
        F.when(site == LIBRARYTHING, found(link, r"([^/]*)$"))
        .when(site == GOODREADS, found(link, r"/show/(.*)$"))
        .when(
            site == AMAZON,
            F.when(username.isNull(), ANONYMOUS).otherwise(found(link, r"/profile/(.*?)/ref=")),
        )
        .when(site == BABELIO, found(link, r"id_user=(.*)$"))
        .when(site == CRITIQUESLIBRES, found(link, r"([^=]*)$"))
    )


def user_name(site: Column | str, uid: Column | str, username: Column | str) -> Column:
    """Name shown: the id itself on one site, a stand-in for anonymous reviewers."""
    site, uid, username = _col(site), _col(uid), _col(username)
    return (
        F.when(site == LIBRARYTHING, uid)
        .when(site == AMAZON, F.coalesce(username, F.lit(ANONYMOUS)))
        .otherwise(username)
    )


def digits_in_parentheses(col: Column | str) -> Column:
    return found(_col(col), r"\((\d+)\)")


def tag_count(site: Column | str, raw: Column) -> Column:
    """Count text of one tag: ``(12)``, ``386 users`` or the font class ``tag_t17 tc0``."""
    site = _col(site)
    return (
        F.when(site == LIBRARYTHING, digits_in_parentheses(raw))
        .when(site == GOODREADS, F.coalesce(found(raw, r"^(.*?)user"), F.lit("0")))
        .when(site == BABELIO, found(raw, r"^.{5}(\S*) "))
    )


def tag_language(site: Column | str) -> Column:
    site = _col(site)
    return F.when(site.isin(LIBRARYTHING, GOODREADS), "eng").when(site == BABELIO, "fre")


def corrected_mds(code: Column | str, texts: Column | str) -> dict[str, Column]:
    """Classification code, its text path and the code cut to the levels that have a text.

    Levels whose text contains a dash are not set. A code with more digits than levels
    is cut to as many digits, with a dot after the third again.
    """
    code, texts = _col(code), _col(texts)
    levels = F.filter(texts, lambda t: ~F.contains(t, F.lit("-")))
    bare = F.replace(code, F.lit("."), F.lit(""))
    cut = F.substring(bare, F.lit(1), F.size(levels))
    dotted = F.when(
        F.length(cut) > 3, F.concat(F.substring(cut, 1, 3), F.lit("."), F.substr(cut, F.lit(4)))
    ).otherwise(cut)
    return {
        "mds_code": code,
        "mds_text": F.replace(F.array_join(levels, "-->"), F.lit("\t"), F.lit("")),
        "mds_code_corr": F.when(F.length(bare) > F.size(levels), dotted),
    }
