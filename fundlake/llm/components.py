"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import stage


def _towards_least(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them: the larger neighbours, or the smaller ones and the node.
    Minima are aggregated before rows meet, so a node with very many neighbours is split like any skewed join."""
    if both_ways:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    met = edges.join(least, "a")
    if both_ways:
        return met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    return met.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b"))).where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component_id``, the least id that can be reached, of every node of ``edges`` (a, b: long).

    Alternating large-star and small-star steps; each step is staged. Self loops and repeated edges make no difference.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    known = None
    while True:
        stepped = stage(_towards_least(_towards_least(edges, True), False), "edges")
        mark = stepped.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if known == mark:
            break
        edges, known = stepped, mark
    stars = stepped.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    return stars.union(stepped.select(F.col("b").alias("id"), F.col("b").alias("component_id"))).distinct()
