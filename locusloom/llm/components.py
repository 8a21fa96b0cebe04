"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads from a node with no other edge to one that leads nowhere."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("leaf")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("leaf")))
    nodes = ends.groupBy("node").agg(F.sum("leaf").alias("up"), F.min("leaf").alias("least"))
    return nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("least") == 0)))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of the edges (a, b), nodes being longs.

    Each round hangs every node's larger neighbours on the smallest node around (large star), then every node and its
    smaller neighbours on the smallest of these (small star), until all edges lead to component minima. Only a
    minimum is taken per node, never its neighbours; rounds are written to shared storage.
    """
    now = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _settled(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = materialize(large, "large-star")
        least = _least_neighbour(large)
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
