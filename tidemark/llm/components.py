"""Connected components of a graph given by its edges, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved


def _no_loops(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a > b, each once."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component): each node of ``edges`` (a, b: bigint) with the smallest node it reaches.

    Large-star and small-star take turns: every node links its larger neighbours, then its smaller ones, to the
    smallest of them, until each component is a star. That takes a number of rounds that grows with the
    logarithm of the nodes. Minima are taken in each task before the shuffle, and a node with very
    many neighbours appears only in a join, whose large partitions Spark splits. Each round is stored. Loops and
    repeated edges count once; an edge with a null end is no edge.
    """
    now = saved(_no_loops(edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select(F.col("a").alias("u"), F.least("a", "low").alias("low"))
        large = both.join(low, F.col("a") == F.col("u")).where("b > a")
        large = saved(_no_loops(large.select(F.col("b").alias("a"), F.col("low").alias("b"))), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "u")
        small = large.join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = saved(_no_loops(small.unionByName(low.select(F.col("u").alias("a"), F.col("low").alias("b")))), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    """Equal for equal sets of edges, and hardly ever for different ones."""
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
    return r["n"], int(r["sum"] or 0)
