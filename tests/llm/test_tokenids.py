import random
import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from shelfmark.llm import tokenids
from shelfmark.session import shared_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "B", "don't", "'s", "'S", " ", "\n", "\t", "!", "...", "=", "\u0338", "\u0301", "É", "I\u0307", "İ", "ß", "…", "日本", "1",
       "½", "<|endoftext|>", "<|", "|>", "<", "_", "-", "\x85", "\x1c", "🙂", "'ll", "K", "ΑΣ", "²", "\u200d", "(", "ﬁ"]


@pytest.fixture(scope="module")
def encoder():
    return tokenids.WordEncoder(PATH)


def test_encoder_equals_library(encoder):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(15))) for _ in range(3000)] + [None, "", " "]
    ids, counts = encoder(pa.array(texts, pa.string()))
    at = np.cumsum(counts)
    for text, a, b in zip(texts, at - counts, at, strict=True):
        assert ids[a:b].tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_full_memory_is_emptied(encoder, monkeypatch):
    monkeypatch.setattr(tokenids, "CACHED_PARTS", 3)
    for _ in range(3):
        ids, _ = encoder(pa.array(["one two three four five six"]))
        assert ids.tolist() == encoder.tokenizer.encode("one two three four five six").ids


@pytest.mark.parametrize("n, step", [(1, 0), (1, 9), (1000, 0), (1000, 1), (700, 5000), (257, 3)])
def test_elias_fano(n, step):
    rng = np.random.default_rng(n + step)
    values = np.cumsum(rng.integers(0, step + 1, n)) if step else np.zeros(n, dtype=np.int64)
    made = tokenids.EliasFano.of(values, int(values[-1]))
    assert made.all().tolist() == values.tolist()
    assert [made.select(i) for i in range(n)] == values.tolist()
    if step == 5000:
        assert 8 * (len(made.low) + len(made.high)) < n * (made.bits + 3)


def test_files_round_trip(spark, docs, encoder, tmp_path, clashing):
    rnd = random.Random(1)
    pairs = [(i * 3, " ".join(rnd.choice(ODD) for _ in range(rnd.randrange(30)))) for i in range(60)]
    pairs += [(None, "no id"), (None, "another"), (6, "same id"), (6, "same id"), (7, None), (8, ""), (9, "w" * 50_000)]
    rnd.shuffle(pairs)
    want, start = [], 0
    for i, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, (p[1] or "").encode())):
        ids = [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    got = tokenids.token_report(docs(pairs, **clashing), PATH, 2, 49_408)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_small_blocks_and_random_access(spark, docs, encoder, monkeypatch):
    pairs = [(i, f"text number {i} of several") for i in range(50)]
    ids, counts = encoder(pa.array([t for _, t in pairs]))
    data = tokenids.to_file([i for i, _ in pairs], counts, ids, 2)
    file = tokenids.TokenFile(data)
    assert len(file) == 50
    for place, (i, text) in enumerate(pairs):
        assert file.doc_ids[place] == i
        assert file.document(place).tolist() == encoder.tokenizer.encode(text).ids
    with pytest.raises(ValueError):
        tokenids.TokenFile(b"XXXX" + data[4:])
    wide = tokenids.TokenFile(tokenids.to_file([1], np.array([2]), np.array([70_000, 1]), 4))
    assert wide.document(0).tolist() == [70_000, 1]


def test_one_id_for_most_rows_spreads_over_ranges(spark, docs, encoder):
    texts = [f"row {i} of one id" for i in range(60)] + ["the same row"] * 60
    pairs = [(4, t) for t in texts] + [(None, t) for t in texts] + [(i, "a b") for i in range(9)]
    folder = f"{shared_folder(spark)}/one-id-{uuid.uuid4().hex}"
    tokenids.write_token_files(docs(pairs), PATH, 2, folder, 49_408)
    assert tokenids.token_files(spark, folder).select("part").distinct().count() > 1
    got = sorted((tuple(r) for r in tokenids.read_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert [r[0] is not None and r[0] for r in got] == sorted((i is not None and i for i, _ in pairs), key=lambda i: (i is not False, i))
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got[:-1]]).tolist()
    of = lambda t: [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2]
    want = Counter((i, len(of(t)), zlib.crc32(np.array(of(t), dtype="<u4").tobytes())) for i, t in pairs)
    assert Counter((r[0], r[2], r[3]) for r in got) == want


def test_empty_table(docs):
    assert tokenids.token_report(docs([]), PATH, 2, 49_408).count() == 0


def test_files_lie_in_the_shared_folder(spark, docs, tmp_path):
    folder = f"{shared_folder(spark)}/one-set-of-files"
    tokenids.write_token_files(docs([(1, "a"), (2, "b")]), PATH, 2, folder, 49_408)
    assert tokenids.token_files(spark, folder).count() >= 1
