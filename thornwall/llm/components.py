"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thornwall.llm.common import Scratch


def _large_star(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or the node itself)."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = scratch.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = scratch.keep(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).filter("u != v").distinct()


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root): each node with a link, and the smallest node it is connected with (roots left out).

    ``edges``: (u, v) of a type with an order. Links are only ever moved, so no
    step holds more rows than there are links; no list of a node's neighbours is
    built. Each round is a table of its own; the rounds grow with the logarithm
    of the longest chain. The end is exact: all nodes point straight at a root.
    """
    edges = scratch.keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct())
    while True:
        roots = edges.select(F.col("v").alias("u")).distinct()
        parents = edges.groupBy("u").agg(F.count("*").alias("n"))
        # A root that has a parent itself, or a node with two, is not settled.
        if parents.join(roots.withColumn("is_root", F.lit(True)), "u", "left").filter("n > 1 or is_root").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        middle = scratch.keep(_large_star(scratch, edges))
        after = scratch.keep(_small_star(scratch, middle))
        scratch.drop(edges)
        scratch.drop(middle)
        edges = after
