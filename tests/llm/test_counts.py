import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import counts
from shelfmark.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, WORD_TOKENIZER

LATE_IDS = "<|endoftext|>"
ODD = [
    None, "", " ", "Hello world", "hello  WORLD ", f"a{LATE_IDS}b", LATE_IDS, "été été", "日本語 テキスト", "don't I'LL",
    "\U0001f600‍\U0001f600 x\x00y", "1 234 ½ ² 五", "a\n\n\n  b\t\tc", "x" * 3000, "Hello world", "_a _b a_ b_"]


def brute(path, text):
    if path.endswith(".model"):
        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text or ""))
    return len(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids)


@pytest.fixture()
def cache(spark):
    return counts.own_cache(spark, "test-counts")


@pytest.mark.parametrize("path", [BYTE_TOKENIZER, WORD_TOKENIZER, PIECE_MODEL])
@pytest.mark.parametrize("sent", [0, 1000])
def test_equals_the_library(docs, clashing, cache, path, sent):
    pairs = [(i, t) for i, t in enumerate(ODD)] + [(None, "Hello world"), (3, "Hello world"), (3, "another text")]
    frame = docs(pairs, **clashing, n_tokens="x", digest="x", text_="x", tokenizer="x")
    out = counts.token_counts(frame, path, cache, sent)
    assert set(out.columns) == set(frame.columns)
    got = sorted(((r.doc_id, r.text, r.n_tokens) for r in out.collect()), key=str)
    assert got == sorted(((i, t, brute(path, t)) for i, t in pairs), key=str)


def test_only_distinct_misses_are_encoded(docs, cache):
    digest = counts.content_digest(BYTE_TOKENIZER, F.col("text"))
    frame = lambda pairs: docs(pairs).select(digest.alias("digest"), "text")
    assert counts.fill(frame([(1, "a b"), (2, "a b"), (3, "c")]), BYTE_TOKENIZER, cache) == 2
    assert counts.fill(frame([(1, "a b"), (4, "d"), (5, "d")]), BYTE_TOKENIZER, cache) == 1
    assert counts.fill(frame([(1, "a b"), (3, "c"), (4, "d")]), BYTE_TOKENIZER, cache) == 0
    version = counts.tokenizer_digest(BYTE_TOKENIZER)
    assert cache.read(version).count() == 3
    # A count appended twice, as by two jobs at once, is one count.
    cache.append(version, cache.read(version))
    assert cache.read(version).count() == 3
    # What is stored is what is given: nothing is counted again.
    cache.append(version, frame([(9, "stored")]).selectExpr("digest", "77L as n_tokens"))
    assert counts.token_counts(docs([(9, "stored")]), BYTE_TOKENIZER, cache).first().n_tokens == 77


def test_versions_do_not_mix(docs, cache):
    frame = docs([(1, "Hello World")])
    a = counts.token_counts(frame, BYTE_TOKENIZER, cache).first().n_tokens
    b = counts.token_counts(frame, PIECE_MODEL, cache).first().n_tokens
    assert (a, b) == (brute(BYTE_TOKENIZER, "Hello World"), brute(PIECE_MODEL, "Hello World"))
    assert len({counts.tokenizer_digest(p) for p in (BYTE_TOKENIZER, WORD_TOKENIZER, PIECE_MODEL)}) == 3


def test_texts_of_one_normal_form_share_a_count(docs, cache):
    pairs = [(1, "Hello World"), (2, "hello world"), (3, "HELLO WORLD"), (4, "<|startoftext|>hello")]
    frame = docs(pairs)
    digest = counts.content_digest(WORD_TOKENIZER, F.col("text"))
    assert counts.tokenizer_of(WORD_TOKENIZER).normalizes and not counts.tokenizer_of(BYTE_TOKENIZER).normalizes
    assert counts.fill(frame.select(digest.alias("digest"), "text"), WORD_TOKENIZER, cache) == 2
    got = {r.doc_id: r.n_tokens for r in counts.token_counts(frame, WORD_TOKENIZER, cache).collect()}
    assert got == {i: brute(WORD_TOKENIZER, t) for i, t in pairs}


def test_long_texts_are_encoded_in_parts(monkeypatch):
    rnd = random.Random(5)
    signs = ["a", "été", "don't", "12", "½", "_", "x_y", "!?", " ", "  ", "\n", LATE_IDS, "日本", "é"]
    whole = counts.tokenizer_of(BYTE_TOKENIZER)
    texts = ["".join(rnd.choice(signs) + rnd.choice(["", " "]) for _ in range(400)) for _ in range(50)]
    expected = whole.counts(texts)
    monkeypatch.setattr(counts, "LONG", 40)
    assert len(whole._parts(texts[0])) > 5 and "".join(whole._parts(texts[0])) == texts[0]
    assert whole.counts(texts) == expected


def test_report_and_empty_table(docs, cache):
    pairs = [(1, "é " * 600), (2, None), (3, "abc")]
    got = {r.doc_id: tuple(r)[1:] for r in counts.count_report(docs(pairs), BYTE_TOKENIZER, cache).collect()}
    assert got == {i: (len((t or "").encode()), brute(BYTE_TOKENIZER, t), brute(BYTE_TOKENIZER, t) > 512) for i, t in pairs}
    assert got[1][2] and not got[2][2]
    empty = counts.own_cache(docs([]).sparkSession, "test-counts")
    assert counts.count_report(docs([]), BYTE_TOKENIZER, empty).count() == 0
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_TOKENIZER


SIGNS = [
    "a", "été", "ÀÉ", "don't", "'s", "'", "-'ll", "12", "½", "_", "x_y", "!?", ".", "(", " ", "  ", "\n", "\t", "\r\n", "\x00", "\x1c",
    "\x7f", "\x85", "\u00a0", "\u2003", "\u3000", "日本", "\U0001f600", "e\u0301", LATE_IDS, "<|", "|>", "<", "endoftext"]


@pytest.mark.parametrize("seed", range(4))
def test_words_give_the_counts_of_the_library(monkeypatch, seed):
    monkeypatch.setattr(counts, "NEW_WORDS", 1)
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(SIGNS) + rnd.choice(["", " "]) for _ in range(rnd.randrange(60))) for _ in range(400)]
    library = Tokenizer.from_file(BYTE_TOKENIZER)
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counts.JsonTokenizer(BYTE_TOKENIZER).counts(texts) == expected


@pytest.mark.parametrize("most", [1_000_000, 10])
def test_words_are_encoded_once(monkeypatch, most):
    monkeypatch.setattr(counts, "KNOWN_WORDS", most)
    one = counts.JsonTokenizer(BYTE_TOKENIZER)
    library, given = one.tokenizer, []

    class Watched:
        def encode_batch_fast(self, parts, **how):
            given.extend(parts)
            return library.encode_batch_fast(parts, **how)

    one.tokenizer = Watched()
    rnd = random.Random(1)
    words = [f"wörd{i}" for i in range(40)] + ["x" * 100]
    texts = [" ".join(rnd.choice(words) + rnd.choice(["", ",", "."]) for _ in range(200)) for _ in range(50)]
    for part in (texts[:25], texts[25:]):
        assert one.counts(part) == [len(library.encode(t, add_special_tokens=False).ids) for t in part]
    assert sum(map(len, given)) < sum(map(len, texts)) / 20
    # Long words are not remembered.
    assert all(len(w) <= counts.WORD_BYTES for w in one._known) and any("x" * 100 in w for w in given)


def test_texts_of_unknown_words_are_encoded_whole():
    one = counts.JsonTokenizer(BYTE_TOKENIZER)
    texts = [" ".join(f"{i}x{j}" for j in range(50)) for i in range(20)]
    assert one.counts(texts) == [len(one.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert not one._known
