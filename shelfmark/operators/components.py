"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, functions as F

from shelfmark.sources.tables import materialize


def _starred(edges: DataFrame, largest: bool) -> DataFrame:
    """One star step: nodes are linked to the smallest node of a neighbourhood.

    The large step links larger neighbours, the small step the node and its smaller ones.
    Neighbourhoods are reduced to their smallest member before the join back, so a node
    with very many neighbours is one key whose rows the join can split.
    """
    if largest:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        linked = near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.min("b").alias("least"))
        linked = near.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b")))
    return linked.filter("a <> b").distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node and root (the smallest node reachable) of every node that has an edge.

    ``edges`` has columns a and b of one orderable type; order, repeats and loops do not
    matter. Alternating star steps; each round is written to the shared folder, and the
    rounds end when one changes nothing. The driver sees one count and checksum a round.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = None
    while True:
        edges = materialize(edges if state is None else _starred(_starred(edges, True), False), name)
        gc.collect()
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
