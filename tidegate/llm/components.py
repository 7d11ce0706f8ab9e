"""Connected components by alternating large-star and small-star, as joins and aggregates.

An edge table of any shape becomes a set of stars whose centre is the smallest node of its
component. Minima are aggregated before every shuffle. A node with very many neighbours is
only ever on the streamed side of a join whose other side is unique and comes by its own
shuffle, so AQE can split it. Every step is a written table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.session import cut_lineage


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m, most): the least and the greatest partner of every node of the pairs (u, v)."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most"))


def _large_star(edges: DataFrame) -> DataFrame:
    """(u, v, moved): every larger partner u of a node is linked to the node's least partner v, or to the node
    itself if that is less. A row per edge; rows may repeat, as the next step aggregates them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut_lineage(_least(both).where("m < u").select("u", "m"))
    larger = both.where("v > u").join(least, "u", "left")
    return cut_lineage(larger.select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v"), F.expr("m is not null").alias("moved")))


def _small_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges (u, v) with v < u: every v, and u, gets linked to u's least partner, which `least` holds."""
    moved = edges.select("u", "v").join(least.select("u", "m"), "u")
    links = moved.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
    return cut_lineage(links.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u != v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v) but the roots themselves.

    Nodes are of any one ordered type. Loops, NULLs, repeated and reversed edges are harmless;
    no edges give no rows.
    """
    ordered = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = cut_lineage(ordered.distinct())
    while True:
        larger = _large_star(edges)
        least = cut_lineage(_least(larger))
        # Stars: nothing moved, and every node that is not a root has one partner.
        if larger.where("moved").isEmpty() and least.where("m != most").isEmpty():
            return least.select(F.col("u").alias("node"), F.col("m").alias("root"))
        edges = _small_star(larger, least)
