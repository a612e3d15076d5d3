import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from shelfmark.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.of_model(PATH)


def number(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(key, data):
    return number(key << 3 | 2) + number(len(data)) + data


def unigram_library(vocabulary):
    """The library's own Viterbi over the same pieces and scores."""
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = b""
    for i in range(model.get_piece_size()):
        kind = 6 if model.is_byte(i) else 2 if model.is_unknown(i) else 3 if model.is_control(i) else 1
        score = float(vocabulary.scores[i]) / 2**20 if kind == 1 else 0.0
        out += field(1, field(1, model.id_to_piece(i).encode()) + number(2 << 3 | 5) + struct.pack("<f", score) + number(3 << 3) + number(kind))
    flag = lambda key, n: number(key << 3) + number(n)
    out += field(2, flag(3, 1) + flag(35, 1) + flag(24, 0) + flag(40, 0))
    out += field(3, field(1, b"identity") + flag(3, 1) + flag(4, 0) + flag(5, 1))
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def cost(vocabulary, ids):
    return sum(vocabulary.scores[i] for i in ids)


def test_paths_are_as_good_as_the_library_s(spark, vocabulary):
    library = unigram_library(vocabulary)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(100).collect()]
    texts += ["", "  a  b\n\tc  ", "a" * 300, "x   y", "   ", "don't stop, it's 3.14!"]
    ids, counts = vocabulary.encode(pa.array(texts))
    at = np.cumsum(counts)
    same = 0
    for text, a, b in zip(texts, at - counts, at, strict=True):
        other = library.encode(text)
        same += ids[a:b].tolist() == other
        assert vocabulary.decode(ids[a:b].tolist()) == library.decode(other) == text
        # The library adds up in single precision, so equal paths can come out differently.
        assert abs(cost(vocabulary, ids[a:b]) - cost(vocabulary, other)) < 2**20 * 0.01
    assert same > 0.9 * len(texts)


def test_side_by_side_equals_one_by_one(vocabulary):
    words = [" the", "日本🙂x".encode().decode(), " théâtre", "aaaaaaaa", " \x00\x01", " 🙃", "  double", " " + "ab" * 60]
    data = [w.encode() for w in words]
    ids, counts = vocabulary._many(
        np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum([0] + [len(d) for d in data])[:-1], np.array([len(d) for d in data]))
    for d, part in zip(data, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert vocabulary._one(d).tolist() == part.tolist()


def test_brute_force_on_a_small_trie():
    table = {b"a": 0, b"ab": 1, b"b": 2, b"ba": 3, b" a": 4, b" ": 5, b"abb": 6}
    scores = np.round(np.array([-2.0, -2.5, -3.0, -2.2, -1.5, -4.0, -5.0]) * 2**20)
    small = pieces.Vocabulary(pieces.DoubleArray(table), scores, -20.0 * 2**20, np.arange(100, 356, dtype=np.int32), [])
    every = {v: k for k, v in table.items()}

    def best(s):
        if not s:
            return 0.0
        options = [scores[i] + best(s[:-len(p)]) for i, p in every.items() if s.endswith(p)]
        return max(options, default=-np.inf)

    for s in ("abab", " abba", "bbab", " aab", "b" * 9, "abb" * 4):
        assert sum(scores[i] for i in small._one(s.encode())) == pytest.approx(best(s.encode()))


def test_byte_fallback_and_markers(vocabulary):
    text = "\U0001f9ff\u0378 \u2581x"
    ids, _ = vocabulary.encode(pa.array([text]))
    assert vocabulary.decode(ids.tolist()) == text.replace(pieces.MARKER, " ")
    assert set(vocabulary.byte_ids.tolist()) & set(ids.tolist())
    assert vocabulary.decode([int(vocabulary.byte_ids[0xFF])]) == "\ufffd"


def test_operators(docs, vocabulary, clashing):
    pairs = [(1, "some text"), (2, None), (3, ""), (1, "some text"), (None, "é" * 5000), (4, "x" * 100_000)]
    frame = docs(pairs, **clashing)
    back = pieces.decoded(pieces.encoded(frame, vocabulary), vocabulary)
    assert sorted((str(r.doc_id), r.text, r.decoded) for r in back.collect() if r.text is not None) == sorted(
        (str(i), t, t) for i, t in pairs if t is not None)
    report = pieces.piece_report(frame, vocabulary).collect()
    assert len(report) == len(pairs) and all(r.same_text for r in report)
    assert {r.n_pieces for r in report if r.doc_id in (2, 3)} == {0}
    assert pieces.piece_report(docs([]), vocabulary).count() == 0
