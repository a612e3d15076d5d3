"""Exact top-k inner products by sequential reading of sorted lists.

Candidates come in bounded slices. A slice holds one list per dimension, its values in
order. Queries read the lists from the end where their contributions are largest, to the
same depth in all lists, and nothing else. What is unread of a member bounds its score: an
unread contribution is at most the last one read from that list and at least the list's
smallest. Since all that was read is beyond the last value read, a member's bound in a list
is the greater of its value and that one, so the bounds of a block of queries are products
of matrices. Members whose upper bound is below the k-th best lower bound leave; a query
stops when no more than k members can be its best, and those get their final scores.

The best scores so far are the bar for the task's next slice; slices grow from small ones,
so that a bar is found early. Tasks return at most k rows per query, ranked in one window
per query. Queries come in blocks of at most ``block`` rows; a block is what is sent to the
workers, so its size is fixed.

Rows are numbered when they are saved: a query is told from other rows by its number, not
by its id. Components are whole numbers, so scores are exact and ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.llm.common import prepared, saved

SCALE = 256
BLOCK = 2048
SLICE = 8192
TOGETHER = 256  # queries whose bounds are worked out at a time
DEPTHS = (0.125, 0.25, 0.5, 0.75, 1.0)  # shares of a list after which bounds are looked at


def _whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vec (whole numbers) of the rows that take part.

    Left out: null ids, null vectors, null or non-finite components.
    """
    def finite(x: Column) -> Column:
        d = x.cast("double")
        return d.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))

    kept = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return kept.filter(F.forall("embedding", finite)).select("vec_id", _whole_numbers(F.col("embedding")).alias("vec"))


class _Slice:
    """Sorted lists over the vectors of a slice."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids = rows, ids
        self.vectors = vectors
        self.lists = np.sort(vectors, axis=0)  # one ascending list per dimension
        self.reach = float(np.abs(vectors).max(initial=0.0))
        self.depth = 0

    def best(
        self, queries: np.ndarray, own: np.ndarray, k: int, bar: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query its place, and places and scores of the members that can be among its k best.

        ``own``: row numbers of the queries; ``bar``: scores that members must reach.
        """
        n = len(self.rows)
        # Whole numbers below 2**24 are exact in single precision, and so are their sums.
        kind = np.float32 if self.reach * float(np.abs(queries).sum(axis=1).max(initial=0.0)) < 1 << 24 else np.float64
        vectors, lists = self.vectors.astype(kind), self.lists.astype(kind)
        rising, falling = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
        waiting, members, bar = np.arange(len(queries)), np.arange(n), bar.copy()
        alive = self.rows[None, :] != own[:, None]
        for depth in sorted({max(1, int(n * share)) for share in DEPTHS}):
            self.depth = depth
            up, down, values = rising[waiting], falling[waiting], vectors[members]
            high, low = lists[n - depth], lists[depth - 1]  # the last values read from either end
            upper = up @ np.maximum(values, high).T + down @ np.minimum(values, low).T
            lower = upper if depth == n else (
                up @ np.where(values >= high, values, lists[0]).T + down @ np.where(values <= low, values, lists[-1]).T)
            if len(members) >= k:
                lower = np.where(alive, lower, kind(-np.inf))
                kth = np.partition(lower, len(members) - k, axis=1)[:, len(members) - k]
                bar[waiting] = np.maximum(bar[waiting], kth)
            alive &= upper >= bar[waiting][:, None]
            done = (alive.sum(axis=1) <= k) | (depth == n)
            for i in np.flatnonzero(done).tolist():
                chosen = members[alive[i]]
                scores = self.vectors[chosen] @ queries[waiting[i]]
                keep = np.lexsort((self.ids[chosen], -scores))[:k]
                yield int(waiting[i]), chosen[keep], scores[keep]
            waiting, alive = waiting[~done], alive[~done]
            if not len(waiting):
                return
            asked = alive.any(axis=0)
            members, alive = members[asked], alive[:, asked]


def _search(queries, k: int, slice_rows: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, tuple] = queries.value
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def read(rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
            part, length = _Slice(rows, ids, vectors), vectors.shape[1]
            own, _, asked = by_length[length]
            for start in range(0, len(own), TOGETHER):
                some = slice(start, start + TOGETHER)
                held = [best.get((length, place)) for place in range(len(own))[some]]
                bar = np.array([h[1].min() if h is not None and len(h[1]) >= k else -np.inf for h in held])
                for i, members, scores in part.best(asked[some], own[some], k, bar):
                    found = ids[members], scores
                    if held[i] is not None:
                        found = tuple(np.concatenate(c) for c in zip(held[i], found, strict=True))
                    keep = np.lexsort((found[0], -found[1]))[:k]
                    best[length, start + i] = found[0][keep], found[1][keep]

        # Slices start small and double: the first ones set the bar for the larger ones.
        wanted: dict[int, int] = {}
        held: dict[int, list[tuple]] = {}
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            lists = batch.column("vec")
            offsets = lists.offsets.to_numpy()
            flat = lists.flatten().to_numpy().astype(np.float64)
            lengths = np.diff(offsets)
            numbers, ids = batch.column("row").to_numpy(), batch.column("vec_id").to_numpy()
            for length in np.unique(lengths).tolist():
                if length not in by_length:
                    continue
                of = np.flatnonzero(lengths == length)
                at = (offsets[of] - offsets[0])[:, None] + np.arange(length)
                held.setdefault(length, []).append((numbers[of], ids[of], flat[at].reshape(len(of), length)))
                size = wanted.setdefault(length, max(1, slice_rows // 16))
                if sum(len(h[0]) for h in held[length]) >= size:
                    read(*(np.concatenate(c) for c in zip(*held.pop(length), strict=True)))
                    wanted[length] = min(2 * size, slice_rows)
        for parts in held.values():
            read(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        for (length, place), (ids, scores) in best.items():
            own, own_ids, _ = by_length[length]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), own[place])), pa.array(np.full(len(ids), own_ids[place])), pa.array(ids),
                 pa.array(scores.astype(np.int64))], ["query_row", "query_id", "vec_id", "score"])

    return search


def top_scores(
    vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK, slice_rows: int = SLICE
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest scores, ties to the smaller id.

    ``vectors``: vec_id (whole number), embedding (array of numbers). Queries are the
    usable rows where ``is_query`` holds, each on its own, also where ids repeat; candidates
    are all usable rows of the query's length but the query's own row. Equal rows count one
    by one. A query without candidates has no row.
    """
    spark = vectors.sparkSession
    prepared(spark)
    numbered = usable(vectors).withColumn("vec_id", F.col("vec_id").cast("long")).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "vec", F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = saved(numbered, "vectors")
    asked = rows.filter("is_query").select("row", "vec_id", "vec")
    blocks = max(1, -(-asked.count() // block))
    found = None
    for i in range(blocks):
        by_length: dict[int, list] = {}
        for r in asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == i).collect():
            by_length.setdefault(len(r["vec"]), []).append(r)
        queries = spark.sparkContext.broadcast({
            length: (np.array([r["row"] for r in some]), np.array([r["vec_id"] for r in some]),
                     np.array([r["vec"] for r in some], dtype=np.float64).reshape(len(some), length))
            for length, some in by_length.items()})
        here = rows.select("row", "vec_id", "vec").mapInArrow(
            _search(queries, k, slice_rows), "query_row long, query_id long, vec_id long, score long")
        found = here if found is None else found.union(here)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
