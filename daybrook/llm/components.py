"""Connected components of an undirected graph, by alternating large-star and small-star steps on a table of edges.

Every step is an aggregate (smallest neighbour, combined before the shuffle) and a join on the node, written to the shared
folder, so nothing of the graph reaches the driver and a lost executor costs one step. The number of rounds grows with the
logarithm of the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from daybrook.llm.common import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node moves to the node's smallest neighbour (itself included)."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Edges run from the larger node ``a``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; ``root`` is the smallest node of its component. Edges: columns a, b."""
    directed = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(directed, "edges")
    seen = None
    while True:
        state = now.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        large = _large(now).distinct()
        now = materialize(_small(large).distinct(), "edges")
    # every edge now leads from a node to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
