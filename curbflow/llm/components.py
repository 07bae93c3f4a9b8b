"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; root is the smallest node reachable.

    Each round links the larger neighbours of every node to its smallest
    neighbour, then the smaller ones; rounds needed grow with the logarithm of
    the nodes. Only minima are grouped, so a node with very many neighbours is
    pre-aggregated before the shuffle, and no group is gathered anywhere.
    Nulls, loops and repeated edges add nothing; no edges give no rows.
    """
    now = stored(_forward(edges), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = stored(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("a").alias("root")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        roots.select(F.col("root").alias("node"), "root")
    )


def _forward(edges: DataFrame) -> DataFrame:
    """Each edge once, smaller node first."""
    return (
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where(F.col("a") < F.col("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _forward(
        both.where("b > a").join(least, "a").select(F.col("m").alias("a"), F.col("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return _forward(
        joined.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
    )
