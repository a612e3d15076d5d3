import random
import re
import time

import pytest

from shelfmark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return {k: [m.span() for m in re.finditer(p, text) if valid(k, m[0])] for k, p in PATTERNS.items()}


def test_plain_equals_the_patterns():
    rnd = random.Random(8)
    parts = ["a", "x.y", "@", "b-c", ".", "..", "1", "25", "255", "256", "0001", "+", "+1", " ", "-", "(", ")", "4111111111111111",
             "378282246310005", "%", "é", "\n", "_", "a@b.c", "@x.y@z.w"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(14)))
        assert pii.plain(text) == brute(text), text


@pytest.mark.parametrize("text, kind, part", [
    ("write to john dot smith at example dot com today", "email", "john dot smith at example dot com"),
    ("mail jane.doe [at] mail.example [dot] org please", "email", "jane.doe [at] mail.example [dot] org"),
    ("bob(at)site.co.uk", "email", "bob(at)site.co.uk"),
    ("bob_at_site_dot_org", "email", "bob_at_site_dot_org"),
    ("bob *at* site *dot* org", "email", "bob *at* site *dot* org"),
    ("bob&#64;site&#46;org", "email", "bob&#64;site&#46;org"),
    ("bob%40site.org", "email", "bob%40site.org"),
    ("bob @ site . org", "email", "bob @ site . org"),
    ("j\u043ehn@ex\u0430mple.com", "email", "j\u043ehn@ex\u0430mple.com"),
    ("ann\u200b.lee@exam\u200bple.com", "email", "ann\u200b.lee@exam\u200bple.com"),
    ("\uff4a\uff4f\uff45\uff20\uff58.example", "email", "\uff4a\uff4f\uff45\uff20\uff58.example"),
    ("host 192[.]168[.]1[.]20 up", "ip", "192[.]168[.]1[.]20"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("card \uff14111 1111 1111 1111", "card", "\uff14111 1111 1111 1111"),
    ("four one one one " + "one " * 11 + "one", "card", "four one one one " + "one " * 11 + "one"),
    ("ring plus one five five five one two three four five six seven now", "phone",
     "plus one five five five one two three four five six seven"),
    ("tel +1 (555) 0l2-34O6 ok", "phone", "+1 (555) 0l2-34O6"),
    ("tel +49 drei null eins zwei drei vier fünf sechs sieben", "phone", "+49 drei null eins zwei drei vier fünf sechs sieben"),
])
def test_disguises_are_mapped_back(text, kind, part):
    found = [s for s in pii.spans_of(text) if not s["plain"]]
    assert (kind, part) in [(s["kind"], text[s["first"]:s["stop"]]) for s in found]
    assert part not in pii.redacted(text)


@pytest.mark.parametrize("text", [
    "He was at the dot com fair.", "See you at example.com at noon.", "un deux trois, un de ces jours",
    "one two three, said the man", "Он сказал: привет", "rates of 3.5 and 4.25 at 2 points", "", "the plus side one of 9",
    "Le un des uns et deux de plus", "version 4.0, section 1.2.3", "a (at) b", "seven or eight or nine of them",
])
def test_clean_texts_stay(text):
    assert pii.spans_of(text) == [] and pii.redacted(text) == text


@pytest.mark.parametrize("text, kind, part", [
    ("card 4111 1111 1111 111 one, thanks", "card", "4111 1111 1111 111 one"),
    ("four 111111111111111 is it", "card", "four 111111111111111"),
    ("host 192.168.0.one is up", "ip", "192.168.0.one"),
    ("host 10.zero.12.254 is up", "ip", "10.zero.12.254"),
    ("ring +49 170 1234 five six seven now", "phone", "+49 170 1234 five six seven"),
    ("ring plus 49170123456 seven now", "phone", "plus 49170123456 seven"),
])
def test_digits_before_and_after_a_spelled_one_count(text, kind, part):
    assert (kind, part) in [(s["kind"], text[s["first"]:s["stop"]]) for s in pii.spans_of(text)]
    assert pii.redacted(text) == text.replace(part, f"[{kind.upper()}]")


@pytest.mark.parametrize("text, kind, part", [
    ("host 192[.]168[.]1[.]25 six times", "ip", "192[.]168[.]1[.]25"),
    ("card \uff14111 1111 1111 1111 one of two", "card", "\uff14111 1111 1111 1111"),
])
def test_a_word_after_a_whole_identifier_does_not_hide_it(text, kind, part):
    assert (kind, part) in [(s["kind"], text[s["first"]:s["stop"]]) for s in pii.spans_of(text)]


@pytest.mark.parametrize("local", [
    "anna dot maria dot luisa dot von dot der dot heide", "a [dot] b(dot)c&#46;d _dot_e dot f_dot_g",
    " dot ".join(f"word{i}" for i in range(300)), "x" * 150 + " dot " + "y" * 150,
])
def test_local_parts_of_any_length(local):
    for rest in (" at example dot com", "@example.com", "(at)example.com"):
        assert pii.redacted(f"to: {local}{rest}, please") == "to: [EMAIL], please"


def test_long_local_parts_take_linear_time():
    for text in ("x dot " * 40_000 + "y@z.com", "x_at_y.z dot " * 20_000, "x_at_y.z_dot_" * 20_000, "a dot b(at)c.d " * 15_000):
        pii.redacted(text)


def test_mixed_runs_take_linear_time():
    for text in ("1 one " * 40_000, "1 " * 150_000 + "one", "one 1" * 60_000, "1.one." * 40_000, "+1 one" * 40_000):
        pii.redacted(text)


def timed(text):
    started = time.process_time()
    pii.spans_of(text)
    return time.process_time() - started


@pytest.mark.parametrize("numbers", ["17 ", "17, ", "1.5 ", "3-4-5 ", "2024-01-02 12:30 ", "1,2,3\n", "(1) ", "7 x ", "+1 ", "12 point "])
def test_numbers_beside_spelled_digits_take_linear_time(numbers):
    """Seconds, where looking again from every number would take many minutes."""
    n = 50_000 // len(numbers)
    for words in ("one two three four five x ", "Step one two three four. ", "nine 9 "):
        for text in (words + numbers * n + "end", numbers * n + words, (numbers * 50 + words) * (n // 50)):
            assert timed(text) < 20


def test_a_long_table_takes_linear_time():
    small, large = (timed("one two three four five x " + "17 " * n + "end") for n in (20_000, 100_000))
    assert large < 12 * max(small, 0.1)


def slow_runs(text):
    """Runs by two patterns tried at every place."""
    word, item = pii._DIGIT_WORD, rf"(?:{pii._DIGIT_WORD}\b|[0-9]+)"
    head = r"(?<![^\W_])(?:(?:\+|plus\b)[ \t]{0,2}(?=.))?"
    spelled = re.compile(rf"{head}(?:[0-9]+{pii._GAP})*\b{word}\b(?:{pii._GAP}{item}){{3,}}(?![^\W_])", re.I)
    mixed = re.compile(rf"{head}(?:\b{word}\b|[0-9]++)(?:{pii._GAP}(?:\b{word}\b|[0-9]++))+(?![^\W_])", re.I)
    both = re.compile(rf"[0-9]{pii._GAP}{word}\b|\b{word}\b{pii._GAP}[0-9]", re.I)
    digit = re.compile(rf"[0-9]|\b{word}\b", re.I)
    return [m.span() for m in spelled.finditer(text)], [
        m.span() for m in mixed.finditer(text) if both.search(m[0]) and len(digit.findall(m[0])) >= 4]


def test_runs_equal_slow_patterns():
    rnd = random.Random(8)
    parts = ["one", "Two", "fünf", "un", "uno", "12", "7", "3456", " ", "  ", "\t", ", ", " - ", "-", ".", " dot ", "[.]", " (",
             ")", "+", "plus ", "x", "_", "3rd", "one's", "\n", "onefold", "%"]
    for _ in range(6000):
        text = "".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randrange(1, 30)))
        assert pii._runs(text) == slow_runs(text), text


def test_plain_spans_stay_beside_added_ones():
    text = "a@b.com and c at d dot org and +1 555 123 4567 and e\u0430@b.com"
    spans = pii.spans_of(text)
    assert [(s["kind"], s["first"], s["stop"]) for s in spans if s["plain"]] == [
        (k, *s) for k in pii.KINDS for s in brute(text)[k]]
    assert sum(not s["plain"] for s in spans) == 2


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 100_000, "one " * 60_000, "x at y " * 40_000,
                 "O0l1" * 60_000, "\u0430" * 200_000, "( at ) " * 40_000, "1 " * 150_000):
        pii.redacted(text)


def test_operators(docs, rows, clashing):
    pairs = [(1, "x a@b.com y"), (2, None), (None, "+1 555 123 4567"), (1, "x a@b.com y"), (3, "")]
    frame = docs(pairs, **clashing)
    report = pii.personal_data_report(frame)
    assert rows(report, "doc_id", "n_email", "n_phone", "spans") == sorted([
        (1, 1, 0, "email:2:9"), (1, 1, 0, "email:2:9"), (2, 0, 0, ""), (3, 0, 0, ""), (None, 0, 1, "phone:0:15")], key=str)
    clean = pii.without_personal_data(frame)
    assert clean.columns == frame.columns
    assert rows(clean, "doc_id", "text") == sorted(
        [(1, "x [EMAIL] y"), (1, "x [EMAIL] y"), (2, None), (3, ""), (None, "[PHONE]")], key=str)
    assert pii.personal_data_report(docs([])).count() == 0
