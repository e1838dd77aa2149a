"""Connected components of links by alternating large-star and small-star steps, each a few joins, staged in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs the neighbours of each node (the larger ones, or the node and the smaller ones) on its smallest neighbour."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.join(least, "a").where("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        out = down.join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y")).unionByName(least.select(F.col("a").alias("x"), F.col("m").alias("y")))
    return out.where("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that can be reached) for every node of the links a, b. Self-links and repeats are allowed."""
    edges = staged(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        new = staged(_stars(_stars(edges, True), False), "edges")
        drop_staged(edges)
        edges = new
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
