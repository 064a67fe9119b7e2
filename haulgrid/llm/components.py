"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrid.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest in the node's neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node (a > b in every edge) and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    kept = least.select("a", F.col("low").alias("b"))
    moved = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return kept.union(moved).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b) but the roots; a root is the least of its kind.

    Alternates large-star and small-star steps, each a minimum per node and a join, until every
    node hangs from its root. Each round is written to the shared folder; what comes back to the
    driver is one count and one sum.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    edges = stored(edges, "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
