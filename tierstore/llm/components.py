"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(pairs: DataFrame) -> DataFrame:
    """Each node u of (u, v) with the smallest node around it: (u, v, low). Joined by merge, as Spark
    sizes the stored links by their packed files."""
    low = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
    return pairs.join(low.hint("merge"), "u")


def _are_stars(edges: DataFrame) -> bool:
    """Does every node that points down point to one node, which points to none?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select("v", F.lit(0), F.lit(1)))
    odd = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down > 1 OR down = 1 AND up = 1")
    return odd.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): component is its smallest node.

    Alternates large-star and small-star steps: every node passes the smallest node around it on
    to its larger, then to its smaller neighbours, until the links are stars around the smallest
    nodes. The number of steps grows with the logarithm of the longest chain. Each step is written
    to the shared folder; only whether the links are stars comes to the driver."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _are_stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stored(small.unionAll(low.select("u", F.col("low").alias("v"))).filter("u <> v").distinct(), "links")
    found = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return found.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
