"""Connected components as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import shared_table


def components(links: DataFrame) -> DataFrame:
    """``(node long, root long)`` for every node of ``links(a long, b long)``; the root is the smallest.

    Alternates two steps until nothing changes: every larger neighbour of a node
    is linked to the node's smallest neighbour, then every smaller one. Each step
    takes minima (combined before the shuffle) and joins them back, so a node with
    very many links is not gathered anywhere. Links live in the shared folder.
    """
    edges = links.where(F.col("a") != F.col("b"))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = shared_table(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = shared_table(larger.where(F.col("a") != F.col("b")).distinct(), "links")
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        joined = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = shared_table(joined.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mixed"),
    ).first()
    return row["n"], row["mixed"]
