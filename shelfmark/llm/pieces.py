"""SentencePiece encoding by unigram Viterbi, with byte fallback, and decoding.

Pieces come from a model file. So do their log scores; a file that ranks its pieces by
merges instead (scores 0, -1, -2, …) gives no probabilities, and the log score of a rank r
is then that of Zipf's law, ``-log(r + 1)`` less the logarithm of the sum. The pieces are kept in a double-array trie over
UTF-8 bytes: a node's child for byte c is ``base[node] + c`` if ``check`` there names the
node. White space is marked: a space counts as the piece marker, and one is put before the
text. No piece holds a marker after another character, so the best path of a text is the
best paths of its segments (a run of markers with what follows up to the next run). Each
distinct segment of a chunk is therefore solved once, all of them side by side: step by
step, the nodes of all open matches move on by one byte.

Scores add up; of paths with equal scores the one whose last piece is longer wins, judged
at every place. A character no piece begins with costs the least score less ten and is
written as its bytes' pieces.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from shelfmark.llm.common import chunks, packed, prepared, ranges, text_bytes, with_fields

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
_UNIT = float(1 << 20)  # scores are whole multiples of its inverse, so sums and ties are exact
_WINDOW = 512  # places tried at a time for a node's children
LONG = 96  # segments of more bytes are solved one by one


class DoubleArray:
    """Double-array trie: base, check and the piece that ends at a node (or -1)."""

    def __init__(self, pieces: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for piece, number in pieces.items():
            node = 0
            for byte in piece:
                node = children[node].setdefault(byte, len(children))
                if node == len(children):
                    children.append({})
                    ends.append(-1)
            ends[node] = number
        size = 2 * len(children) + 512
        base = np.zeros(size, dtype=np.int32)
        check = np.full(size, -1, dtype=np.int32)
        taken = np.zeros(size, dtype=bool)
        piece_at = np.full(size, -1, dtype=np.int32)
        taken[0] = True
        place = {0: 0}
        lowest = 1
        for node in self._by_level(children):
            bytes_of = sorted(children[node])
            if not bytes_of:
                continue
            while taken[lowest]:
                lowest += 1
            start = max(1, lowest - bytes_of[0])
            while True:
                if start + 2 * _WINDOW >= len(taken):
                    grow = len(taken)
                    base, taken = np.append(base, np.zeros(grow, np.int32)), np.append(taken, np.zeros(grow, bool))
                    check, piece_at = (np.append(x, np.full(grow, -1, np.int32)) for x in (check, piece_at))
                if not any(taken[start + byte] for byte in bytes_of):
                    break
                used = taken[start + bytes_of[0]:start + bytes_of[0] + _WINDOW].copy()
                for byte in bytes_of[1:]:
                    used |= taken[start + byte:start + byte + _WINDOW]
                first = int(used.argmin())
                start += _WINDOW if used[first] else first
            at = place[node]
            base[at] = start
            for byte in bytes_of:
                child = children[node][byte]
                slot = start + byte
                taken[slot], check[slot], piece_at[slot] = True, at, ends[child]
                place[child] = slot
        last = int(np.flatnonzero(taken)[-1]) + 257
        self.base, self.check, self.piece = base[:last].copy(), check[:last].copy(), piece_at[:last].copy()

    @staticmethod
    def _by_level(children: list[dict[int, int]]) -> Iterator[int]:
        level = [0]
        while level:
            yield from level
            level = [c for node in level for c in children[node].values()]


@dataclass
class Vocabulary:
    """What the workers need of a model: trie, scores and the bytes of every piece."""

    trie: DoubleArray
    scores: np.ndarray
    unknown: float
    byte_ids: np.ndarray  # id of each byte's piece
    spelled: list[bytes]  # bytes each piece decodes to

    @classmethod
    def of_model(cls, path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        scores = np.array([model.get_score(i) for i in range(n)])
        normal, spelled, byte_ids = {}, [], np.full(256, model.unk_id(), dtype=np.int32)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled.append(b"")
            else:
                spelled.append(piece.replace(MARKER, " ").encode())
                normal[spelled[-1]] = i
        if any(b" " in p.lstrip(b" ") for p in normal):
            raise ValueError("a piece holds a marker after another character; segments would not be independent")
        used = np.fromiter(normal.values(), dtype=np.int64)
        if (scores[used] == np.round(scores[used])).all():  # ranks
            shares = 1.0 / (1.0 - scores[used])
            scores[used] = np.log(shares / shares.sum())
        unknown = float(scores[used].min()) - UNKNOWN_PENALTY
        return cls(DoubleArray(normal), np.round(scores * _UNIT), round(unknown * _UNIT), byte_ids, spelled)

    # Viterbi --------------------------------------------------------------------------------

    def _one(self, segment: bytes) -> np.ndarray:
        """Ids of one segment, by the plain recurrence."""
        base, check, piece = self.trie.base, self.trie.check, self.trie.piece
        n = len(segment)
        best, back, by = np.full(n + 1, -np.inf), np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        best[0] = 0.0
        for i in range(n):
            if best[i] == -np.inf:
                continue
            char = 1 if segment[i] < 128 else 2 if segment[i] < 224 else 3 if segment[i] < 240 else 4
            node, whole = 0, False
            for j in range(i, n):
                slot = base[node] + segment[j]
                if check[slot] != node:
                    break
                node = slot
                if piece[node] >= 0:
                    whole |= j + 1 - i == char
                    score = best[i] + self.scores[piece[node]]
                    if score > best[j + 1]:
                        best[j + 1], back[j + 1], by[j + 1] = score, i, piece[node]
            if not whole and best[i] + self.unknown > best[i + char]:
                best[i + char], back[i + char], by[i + char] = best[i] + self.unknown, i, -1
        out: list[int] = []
        at = n
        while at:
            start = int(back[at])
            out += [int(by[at])] if by[at] >= 0 else self.byte_ids[list(segment[start:at])][::-1].tolist()
            at = start
        return np.array(out[::-1], dtype=np.int32)

    def _many(self, data: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many segments (stretches of ``data``) and how many each has."""
        base, check, piece = self.trie.base, self.trie.check, self.trie.piece
        cell = np.cumsum(lengths + 1) - lengths - 1  # of each segment's place 0
        cells = int((lengths + 1).sum())
        best, back, by = np.full(cells, -np.inf), np.zeros(cells, np.int32), np.full(cells, -1, np.int32)
        best[cell] = 0.0
        width = np.array([1] * 192 + [2] * 32 + [3] * 16 + [4] * 16, dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        for i in range(int(lengths.max(initial=0))):
            open_now = order[:int(np.searchsorted(-lengths[order], -i, side="left"))]
            open_now = open_now[best[cell[open_now] + i] > -np.inf]
            if not len(open_now):
                continue
            char = width[data[first[open_now] + i]]
            whole = np.zeros(len(open_now), dtype=bool)
            reached = best[cell[open_now] + i]
            live, node = np.arange(len(open_now)), np.zeros(len(open_now), dtype=np.int32)
            step = 0
            while len(live):
                segment = open_now[live]
                slot = base[node] + data[first[segment] + i + step]
                ok = check[slot] == node
                live, node, segment = live[ok], slot[ok], segment[ok]
                step += 1
                ends = piece[node]
                here = ends >= 0
                if here.any():
                    at = cell[segment[here]] + i + step
                    score = reached[live[here]] + self.scores[ends[here]]
                    whole[live[here]] |= char[live[here]] == step
                    better = score > best[at]
                    at = at[better]
                    best[at], back[at], by[at] = score[better], step, ends[here][better]
                more = lengths[segment] > i + step
                live, node = live[more], node[more]
            lost = np.flatnonzero(~whole)
            if len(lost):
                at = cell[open_now[lost]] + i + char[lost]
                score = reached[lost] + self.unknown
                better = score > best[at]
                at = at[better]
                best[at], back[at], by[at] = score[better], char[lost][better], -1
        # Back along the best paths, all segments at once; ids come out last first.
        owner, ids = [], []
        live, at = np.arange(len(lengths)), lengths.copy()
        live, at = live[at > 0], at[at > 0]
        while len(live):
            here = cell[live] + at
            length, number = back[here], by[here]
            as_bytes = number < 0
            owner.append(live[~as_bytes])
            ids.append(number[~as_bytes])
            if as_bytes.any():
                # A character without a piece: its bytes, last first, then on with the rest.
                who, size = live[as_bytes], length[as_bytes].astype(np.int64)
                for k in range(1, int(size.max()) + 1):
                    has = size >= k
                    owner.append(who[has])
                    ids.append(self.byte_ids[data[first[who[has]] + at[as_bytes][has] - k]])
            at = at - length
            live, at = live[at > 0], at[at > 0]
        if not owner:
            return np.zeros(0, dtype=np.int32), np.zeros(len(lengths), dtype=np.int64)
        owner, ids = np.concatenate(owner), np.concatenate(ids)
        by_owner = np.argsort(owner[::-1], kind="stable")
        return ids[::-1][by_owner], np.bincount(owner, minlength=len(lengths))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk of texts, and how many each text has."""
        texts = [t.replace(MARKER, " ") for t in column.to_pylist() if t is not None] if any(
            MARKER.encode() in (b or b"") for b in column.cast(pa.binary()).to_pylist()) else None
        if texts is not None:
            full = iter(texts)
            column = pa.array([None if v is None else next(full) for v in column.to_pylist()], pa.string())
        data, offsets = text_bytes(column)
        lengths = np.diff(offsets)
        # The marker before each text that is not empty.
        with_marker = np.insert(np.frombuffer(data, dtype=np.uint8), offsets[:-1][lengths > 0], 32)
        sizes = lengths + (lengths > 0)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        if not len(with_marker):
            return np.zeros(0, dtype=np.int32), np.zeros(len(column), dtype=np.int64)
        space = with_marker == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[bounds[:-1][sizes > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(with_marker))
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, ends[-1]).astype(np.int64)), pa.py_buffer(with_marker.tobytes())])
        coded = packed.dictionary_encode()
        codes, values = coded.indices.to_numpy(), coded.dictionary
        raw, at = text_bytes(values)
        ids, counts = self._segments(np.frombuffer(raw, dtype=np.uint8), at)
        first = np.cumsum(counts) - counts
        per_segment = counts[codes]
        out = ids[ranges(first[codes], per_segment)]
        total = np.concatenate([[0], np.cumsum(per_segment)])
        return out, np.diff(total[np.searchsorted(starts, bounds)])

    def _segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.diff(offsets)
        short = lengths <= LONG
        ids, counts = self._many(data, offsets[:-1][short], lengths[short])
        if short.all():
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        out: list = [None] * len(lengths)
        for i, part in zip(np.flatnonzero(short).tolist(), parts, strict=False):
            out[i] = part
        for i in np.flatnonzero(~short).tolist():
            out[i] = self._one(data[offsets[i]:offsets[i + 1]].tobytes())
        return np.concatenate(out), np.array([len(o) for o in out], dtype=np.int64)

    def decode(self, ids: Iterable[int]) -> str:
        """Text of a sequence of ids: markers become spaces, the first one goes, bytes are put together."""
        out = b"".join([self.spelled[i] for i in ids])
        return out.removeprefix(b" ").decode("utf-8", "replace")


def _encode(vocabulary, columns: list[str]):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            ids, counts = vocabulary.value.encode(part.column("text"))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))],
                [*columns, "piece_ids"])

    return encode


def encoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``docs`` with piece_ids (array of int); a column of that name is replaced.

    Null and empty texts have no ids. A character that looks like the marker is taken as a
    space. Rows are encoded one by one, so repeated rows and null ids need no rule.
    """
    prepared(docs.sparkSession)
    kept = docs.drop("piece_ids")
    rows = packed(kept, "text")
    layout = with_fields(rows, ["row"], ("piece_ids", ArrayType(IntegerType())))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return rows.mapInArrow(_encode(shared, ["row"]), layout).select("row.*", "piece_ids")


def _decode(vocabulary, columns: list[str]):
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else vocabulary.value.decode(ids) for ids in batch.column("piece_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(texts, pa.string())], [*columns, "decoded"])

    return decode


def decoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``docs`` (with piece_ids) with decoded, the text of the ids; null ids give null."""
    prepared(docs.sparkSession)
    kept = docs.drop("decoded")
    rows = packed(kept, "piece_ids")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return rows.mapInArrow(
        _decode(shared, ["row"]), with_fields(rows, ["row"], ("decoded", StringType()))).select("row.*", "decoded")


def _report(vocabulary):
    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Vocabulary = vocabulary.value
        is_byte = np.zeros(len(model.spelled), dtype=bool)
        is_byte[model.byte_ids] = True
        for part in chunks(batches):
            ids, counts = model.encode(part.column("text"))
            ends = np.cumsum(counts)
            raw = memoryview(ids.astype("<u4").tobytes())
            spans = list(zip((ends - counts).tolist(), ends.tolist(), strict=True))
            texts = [model.decode(ids[a:b].tolist()) for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array([int(is_byte[ids[a:b]].sum()) for a, b in spans], pa.int64()),
                 pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in spans], pa.int64()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                 pa.array([t == (s or "").replace(MARKER, " ") for t, s in zip(texts, part.column("text").to_pylist(), strict=True)])],
                ["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "decoded_sha256", "same_text"])

    return report


def piece_report(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row: doc_id, numbers of pieces and of byte pieces, crc32 of the ids (as little-endian
    32-bit numbers), SHA-256 of the text decoded from them, and whether that is the text."""
    prepared(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return docs.select("doc_id", "text").mapInArrow(
        _report(shared), f"doc_id {id_type}, n_pieces long, n_byte_pieces long, ids_crc32 long, "
        "decoded_sha256 string, same_text boolean")
