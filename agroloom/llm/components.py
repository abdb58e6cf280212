"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.operators.scale import null_safe_join
from agroloom.session import checkpointed


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(neighbours: DataFrame) -> DataFrame:
    """Rows (a, b) with the least of a and all its b; partial minima are taken before the shuffle."""
    least = neighbours.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return null_safe_join(neighbours, least, ["a"], "inner")


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    rows = _with_least(_both_ways(edges)).where("b > a")
    return rows.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rows = _with_least(down)
    links = rows.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(rows.select("a", F.col("least").alias("b")))
    return links.where("a != b").distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """node, root for every node of (a, b) edges; the root is the least node of its component and has a row too."""
    edges = checkpointed(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        edges = checkpointed(small_star(large_star(edges)))
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if mark == last or not mark["n"]:
            break
        last = mark
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
