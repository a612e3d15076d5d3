"""Personal data in texts, plain and disguised, as spans of source characters.

Plain identifiers are found first, by kind: leftmost, non-overlapping matches of the
patterns below, matches that fail their check dropped.

Disguised ones are found by two transducers, each of which keeps where its output came
from. The first folds look-alike characters to ASCII and drops invisible ones. The second
rewrites spelled digits, spelled or bracketed "at", "dot", "plus", and letters put for
digits, but only inside expressions that have the shape of an identifier, so ordinary
prose is not touched. The plain detectors then run over the normalised text, and a match
that touches a rewritten place is mapped back to the source characters it came from.

Texts are looked at one by one, whole, in time linear in their length.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import chunks, packed, prepared, quoted, with_fields

KINDS = ("email", "ip", "card", "phone")

# Plain identifiers -----------------------------------------------------------------------

_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Starting inside a run of digits cannot match where starting at its head fails.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``.

    Led by the at signs: the local part is the run of its characters before the sign that
    the match before has not used, so a long text without a sign costs one search.
    """
    out: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at) if begin < at else None
        if domain:
            last = domain.end()
            out.append((begin, last))
        else:
            last = max(last, at)
        at = text.find("@", max(at + 1, last))
    return out


def addresses(text: str) -> list[Span]:
    return [
        m.span() for m in _IP.finditer(text)
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
    ]


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def plain(text: str) -> dict[str, list[Span]]:
    """Spans by kind of the identifiers that stand in the text as they are."""
    digits = _DIGIT.search(text) is not None
    return {
        "email": emails(text) if "@" in text else [],
        "ip": addresses(text) if digits else [],
        "card": cards(text) if digits else [],
        "phone": phones(text) if digits and "+" in text else [],
    }


# First transducer: characters ------------------------------------------------------------

# Letters of other scripts that look like the Latin letter below them.
_LOOKS = "АВЕЅІЈКМНОРСТУХавеѕіјкмнорстухһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχ"
_LATIN = "ABESIJKMHOPCTYXabesijkmhopctyxhdqwABEZHIKMNOPTYXaiknopux"
_INVISIBLE = "\u00ad\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"
_DASHES = "\u2010\u2011\u2012\u2013\u2014\u2212\ufe63\uff0d"
_ODD = re.compile("[^\\x00-\\xac\\xae-\\u024f]")


class _Folds(dict):
    """What a code point is folded to: itself, an ASCII character, or None if invisible.

    Compatibility forms (full width, mathematical, circled letters) and the decimal digits
    of all scripts follow from Unicode's own tables; look-alikes are listed above.
    """

    def __missing__(self, point: int):
        c = chr(point)
        if c in _INVISIBLE:
            out = None
        elif c in _LOOKS:
            out = _LATIN[_LOOKS.index(c)]
        elif c in _DASHES:
            out = "-"
        elif point > 0x24F:
            form = unicodedata.normalize("NFKC", c)
            out = form if len(form) == 1 and form.isascii() else str(unicodedata.decimal(c, "")) or c
        else:
            out = c
        self[point] = out
        return out


_FOLDS = _Folds()


def folded(text: str) -> tuple[str, np.ndarray | None]:
    """The text with characters folded, and the source place of each (None: unchanged)."""
    if text.isascii() or not _ODD.search(text):
        return text, None
    out = [_FOLDS[ord(c)] for c in text]
    places = np.array([i for i, c in enumerate(out) if c is not None], dtype=np.int64)
    new = "".join(c for c in out if c is not None)
    return (text, None) if new == text else (new, places)


# Second transducer: expressions ----------------------------------------------------------

# Digits, signs as words, in English, German, French and Spanish.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5",
    "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5",
    "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_DOT_WORDS = ("dot", "period", "punkt", "point", "punto")
_AT_WORDS = ("at", "arroba", "klammeraffe", "arobase")
_NO_LABELS = frozenset(("a", "an", "the", "this", "that", "our", "your", "my", "its", "each", "every"))
_words = lambda words: "|".join(sorted(words, key=len, reverse=True))

_OPEN, _CLOSE = r"[ \t]{0,2}[\[({<_*][ \t]?", r"[ \t]?[\])}>_*][ \t]{0,2}"
# The signs as character references.
_AT_CODE, _DOT_CODE = r"&#(?:64|x40);|&commat;|%40", r"&#(?:46|x2e);|&period;"
_HIDDEN_DOT = rf"(?:{_OPEN}(?:{_words(_DOT_WORDS)}|\.){_CLOSE}|{_DOT_CODE}|[ \t]{{1,2}}(?:{_words(_DOT_WORDS)})[ \t]{{1,2}})"
_ANY_DOT = rf"(?:{_HIDDEN_DOT}|[ \t]\.[ \t]|\.)"
_FLAGS = re.IGNORECASE
_BOX_AT = re.compile(rf"{_OPEN}(?:{_words(_AT_WORDS)}|@){_CLOSE}|{_AT_CODE}", _FLAGS)
_WORD_AT = re.compile(rf"[ \t]{{1,2}}(?:{_words(_AT_WORDS)})[ \t]{{1,2}}", _FLAGS)
_SIGN_AT = re.compile(r"[ \t]{0,2}@[ \t]{0,2}")
_AFTER_AT = re.compile(rf"[A-Za-z0-9-]+(?:{_ANY_DOT}[A-Za-z0-9-]+)+", _FLAGS)
_DOTS = re.compile(_ANY_DOT, _FLAGS)
_HAS_DOT = re.compile(_HIDDEN_DOT, _FLAGS)
_DOT_LENGTH = 14  # characters of the longest hidden dot
_AT_HINT = re.compile(rf"@|{_AT_CODE}|[\[({{<_*][ \t]?(?:{_words(_AT_WORDS)})|[ \t](?:{_words(_AT_WORDS)})[ \t]", _FLAGS)

_DIGIT_WORD = rf"(?:{_words(_DIGIT_WORDS)})"
_GAP = rf"(?:[ \t]{{1,2}}|,[ \t]?|[ \t]?-[ \t]?|{_ANY_DOT}|[ \t]?[()][ \t]?)"
# Items of a run: spelled digits and numbers, with a gap between neighbours. An item is a whole word.
_ITEM = rf"(?:(?P<word>\b{_DIGIT_WORD}\b)|(?P<digits>[0-9]++))(?![^\W_])"
_FIRST = re.compile(rf"(?<![^\W_])(?:(?:\+|plus\b)[ \t]{{0,2}}(?=.))?{_ITEM}", _FLAGS)
_NEXT = re.compile(_GAP + _ITEM, _FLAGS)
# A spelled digit beside another item: without one a text has no run to look at.
_RUN_HINT = re.compile(rf"[0-9]{_GAP}{_DIGIT_WORD}\b|\b{_DIGIT_WORD}\b{_GAP}(?:{_DIGIT_WORD}\b|[0-9])", _FLAGS)
_BOX_IP = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:(?:{_HIDDEN_DOT}|\.)[0-9]{{1,3}}){{3}}(?![0-9])", _FLAGS)
_PLUS_WORD = re.compile(r"\bplus[ \t]{1,2}(?=[0-9])", _FLAGS)
_MIXED = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OoIl](?:[ ().-]{0,2}[0-9OoIl]){8,}(?![A-Za-z0-9])")
_LETTER_DIGITS = str.maketrans("OoIl", "0011")
_TOKEN = re.compile(rf"(?P<plus>\+|plus\b[ \t]{{0,2}})|(?P<word>\b{_DIGIT_WORD}\b)|(?P<digits>[0-9]+)|(?P<dot>{_ANY_DOT})|(?P<gap>.)", _FLAGS | re.DOTALL)

Edit = tuple[int, int, str]


def _local_part(text: str, least: int, stop: int) -> int:
    """Where the runs of local characters, joined by hidden dots, begin that end at ``stop``; not before ``least``."""
    first, ends, seen = stop, [stop], set()
    while ends:
        begin = stop = ends.pop()
        while begin > least and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        first = min(first, begin)
        # Hidden dots over the place before, with a run on both sides.
        for at in range(max(least + 1, begin - _DOT_LENGTH), begin):
            if at not in seen and text[at - 1] in _LOCAL_CHARS:
                dot = _HAS_DOT.match(text, at, stop - 1)
                if dot and dot.end() >= begin:
                    seen.add(at)
                    ends.append(at)
    return first


def _email_edits(text: str) -> Iterator[Edit]:
    """Signs inside an address: a boxed at, or a spelled at whose domain has a hidden dot."""
    if not _AT_HINT.search(text):
        return
    for pattern, needs_dot in ((_BOX_AT, False), (_SIGN_AT, False), (_WORD_AT, True)):
        last = 0
        for m in pattern.finditer(text):
            after = _AFTER_AT.match(text, m.end())
            if not after or (needs_dot and not _HAS_DOT.search(after[0])):
                continue
            if needs_dot and after[0].split(None, 1)[0].lower() in _NO_LABELS:
                continue
            if not m.start() or text[m.start() - 1] not in _LOCAL_CHARS:
                continue
            # What stands before the last sign was that sign's local part.
            begin = _local_part(text, last, m.start())
            last = m.end()
            for dot in _HAS_DOT.finditer(text, begin, m.start()):
                yield dot.start(), dot.end(), "."
            if m[0] != "@":
                yield m.start(), m.end(), "@"
            for dot in _DOTS.finditer(text, m.end(), after.end()):
                if dot[0] != ".":
                    yield dot.start(), dot.end(), "."


def _runs(text: str) -> tuple[list[Span], list[Span]]:
    """Maximal runs of items, each looked at once: the spelled ones, and the mixed ones.

    Spelled: at least three items follow the first spelled digit. Mixed: digits and spelled
    ones, at least four in all.
    """
    spelled: list[Span] = []
    mixed: list[Span] = []
    if not _RUN_HINT.search(text):
        return spelled, mixed
    first = _FIRST.search(text)
    while first:
        begin, item = first.start(), first
        items = words = digits = after = 0
        while item:
            items += 1
            if item["word"]:
                words += 1
                digits += 1
            else:
                digits += len(item["digits"])
            after += words > 0
            end = item.end()
            item = _NEXT.match(text, end)
        if after > 3:
            spelled.append((begin, end))
        if 0 < words < items and digits >= 4:
            mixed.append((begin, end))
        first = _FIRST.search(text, end)
    return spelled, mixed


def _number_edits(text: str, runs: list[Span]) -> Iterator[Edit]:
    """Spelled digits and signs in ``runs``; letters put for digits."""
    for begin, end in runs:
        for t in _TOKEN.finditer(text, begin, end):
            if t["plus"]:
                if t[0] != "+":
                    yield t.start(), t.end(), "+"
            elif t["word"]:
                yield t.start(), t.end(), _DIGIT_WORDS[t[0].lower()]
            elif t["dot"]:
                if t[0] != ".":
                    yield t.start(), t.end(), "."
            elif t["gap"]:
                yield t.start(), t.end(), ""
    for m in _BOX_IP.finditer(text):
        for dot in _HAS_DOT.finditer(text, m.start(), m.end()):
            yield dot.start(), dot.end(), "."
    for m in _PLUS_WORD.finditer(text):
        yield m.start(), m.end(), "+"
    for m in _MIXED.finditer(text):
        digits = sum(c.isdigit() for c in m[0])
        letters = sum(c.isalpha() for c in m[0])
        if 0 < letters < digits:
            for i in range(m.start(), m.end()):
                if text[i].isalpha():
                    yield i, i + 1, text[i].translate(_LETTER_DIGITS)


def rewritten(text: str, runs: list[Span]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray] | None:
    """The text with expressions, ``runs`` of items among them, rewritten; per character its source start, end and whether it is new."""
    edits: list[Edit] = []
    for edit in sorted({*_email_edits(text), *_number_edits(text, runs)}, key=lambda e: (e[0], -e[1])):
        if not edits or edit[0] >= edits[-1][1]:
            edits.append(edit)
    if not edits:
        return None
    pieces, starts, ends, new, last = [], [], [], [], 0
    for begin, end, to in [*edits, (len(text), len(text), "")]:
        pieces.append(text[last:begin])
        starts.append(np.arange(last, begin))
        ends.append(np.arange(last + 1, begin + 1))
        new.append(np.zeros(begin - last, dtype=bool))
        pieces.append(to)
        starts.append(np.full(len(to), begin))
        ends.append(np.full(len(to), end))
        new.append(np.ones(len(to), dtype=bool))
        last = end
    return "".join(pieces), np.concatenate(starts), np.concatenate(ends), np.concatenate(new)


def disguised(text: str, known: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans by kind that show only in the normalised text; none lies inside a known one.

    Digits beside a spelled one may be an identifier without it ("192[.]168[.]1[.]25 six
    times"), so a text with such runs is looked at twice, without and with them joined.
    """
    first, places = folded(text)
    spelled, mixed = _runs(first)
    out = _disguised(text, first, places, spelled, known)
    if mixed:
        for kind, spans in _disguised(text, first, places, sorted({*spelled, *mixed}), known).items():
            out[kind] = sorted({*out[kind], *spans})
    return out


def _disguised(
    text: str, first: str, places: np.ndarray | None, runs: list[Span], known: dict[str, list[Span]]
) -> dict[str, list[Span]]:
    second = rewritten(first, runs)
    if places is None and second is None:
        return {k: [] for k in KINDS}
    if second is None:
        normal, starts, ends = first, places, places + 1
        new = np.array([first[i] != text[p] for i, p in enumerate(places)], dtype=bool)
        new[1:] |= np.diff(places) > 1
    else:
        normal, starts, ends, new = second
        if places is not None:
            changed = np.array([first[i] != text[p] for i, p in enumerate(places)], dtype=bool)
            new = new | changed[starts]
            new[1:] |= starts[1:] > ends[:-1]
            ends = places[ends - 1] + 1
            starts = places[starts]
    touched = np.concatenate([[0], np.cumsum(new)])
    out = {}
    for kind, spans in plain(normal).items():
        found = []
        firsts = [x for x, _ in known[kind]]
        for a, b in spans:
            # A gap that was dropped inside the match is a change as well.
            if touched[b] > touched[a] or (starts[a + 1:b] > ends[a:b - 1]).any():
                span = int(starts[a]), int(ends[b - 1])
                # Known spans of a kind are in order and apart: only the last one before can hold this one.
                before = bisect_right(firsts, span[0]) - 1
                if before < 0 or known[kind][before][1] < span[1]:
                    found.append(span)
        out[kind] = found
    return out


# Operators -------------------------------------------------------------------------------

_SPAN = pa.struct([("kind", pa.string()), ("first", pa.int64()), ("stop", pa.int64()), ("plain", pa.bool_())])
_SPAN_SQL = "array<struct<kind:string,first:long,stop:long,plain:boolean>>"


def spans_of(text: str) -> list[dict]:
    known = plain(text)
    more = disguised(text, known)
    return [
        {"kind": kind, "first": a, "stop": b, "plain": is_plain}
        for kind in KINDS
        for a, b, is_plain in sorted([(*s, True) for s in known[kind]] + [(*s, False) for s in more[kind]])
    ]


def _find(columns: list[str]):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            found = [spans_of(text or "") for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(found, pa.list_(_SPAN))], [*columns, "spans"])

    return find


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans: kind, first, stop (code points, end exclusive) and plain.

    Spans are in the order of KINDS, then by place. A null text is empty. One row per row,
    whatever ids are null or repeated; other columns are ignored.
    """
    prepared(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_find(["doc_id"]), f"doc_id {id_type}, spans {_SPAN_SQL}")


def redacted(text: str) -> str:
    """The text with each identifier, or run of overlapping ones, replaced by ``[KIND]``."""
    out, last = [], 0
    merged: list[list] = []
    for s in sorted(spans_of(text), key=lambda s: (s["first"], -s["stop"])):
        if merged and s["first"] < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s["stop"])
        else:
            merged.append([s["first"], s["stop"], s["kind"]])
    for first, stop, kind in merged:
        out += [text[last:first], f"[{kind.upper()}]"]
        last = stop
    return "".join([*out, text[last:]])


def _redact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        texts = [None if t is None else redacted(t) for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` (same columns) with identifiers in ``text`` replaced by their kind."""
    prepared(docs.sparkSession)
    rows = packed(docs, "text", without=("text",))
    out = rows.mapInArrow(_redact, with_fields(rows, ["row", "text"]))
    return out.select(*(F.col("text") if c == "text" else F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns))


def personal_data_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the plain spans by kind, and all spans as text."""
    found = personal_data(docs)
    base = F.filter("spans", lambda s: s["plain"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["stop"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(k) for k in KINDS), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["plain"])).cast("long").alias("n_disguised"))
