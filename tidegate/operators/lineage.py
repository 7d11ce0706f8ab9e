"""Lineage graph over an edge table: dependents, levels, impact of failures.

A traversal stores its edges once, in buckets by parent, sorted: joining them with a frontier
shuffles the frontier alone, and a small one, which is measured, is broadcast. A bucket holds
all edges of a parent, so parents with very many are found by a sketch first; their edges are
a table of their own, which only ever meets those few names. Nodes are deduplicated by
aggregates that are partial before their shuffle. Rounds end their lineage in a reliable
checkpoint, so a lost executor costs one round at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.sizing import heavy_hitters, measured, settle
from tidegate.session import cut_lineage, scratch_path

NODE_KINDS = ("model", "snapshot", "source")

# A frontier is wide while the nodes seen so far are at most this many times as many.
_WIDE_FRONTIER = 8
# Rounds in which `levels` lets nodes come again before it counts parents instead.
_SHALLOW = 8
_SORTED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def links(nodes: DataFrame) -> DataFrame:
    """(parent, child) pairs of a node table (unique_id, resource_type, depends_on), repeated as they are there."""
    return nodes.where(F.col("resource_type").isin(*NODE_KINDS)).select(
        F.explode("depends_on").alias("parent"), F.col("unique_id").alias("child")
    )


def edges(nodes: DataFrame) -> DataFrame:
    """The distinct `links` of a node table."""
    return links(nodes).distinct()


class _Edges(NamedTuple):
    spread: DataFrame  # bucketed by parent
    hot: DataFrame | None  # the edges of the parents that have very many
    hot_parents: list[str]

    def leaving(self, frontier: DataFrame) -> DataFrame:
        """The edges that leave the frontier's nodes, with the frontier's other columns."""
        begun = frontier.withColumnRenamed("node", "parent")
        found = self.spread.join(begun, "parent")
        if self.hot is None:
            return found
        few = begun.where(F.col("parent").isin(self.hot_parents))
        return found.unionByName(self.hot.join(F.broadcast(few), "parent"))


@contextmanager
def _stored(edge_table: DataFrame) -> Iterator[_Edges]:
    """The distinct edges as a traversal's rounds read them. The catalog's entry goes at the end."""
    spark = edge_table.sparkSession
    pairs = edge_table.select("parent", "child").where("parent is not null")
    hot_parents = heavy_hitters(pairs, F.col("parent"))
    hot, name = None, "tidegate_edges_" + uuid.uuid4().hex
    if hot_parents:
        hot = cut_lineage(pairs.where(F.col("parent").isin(hot_parents)).distinct())
        pairs = pairs.where(~F.col("parent").isin(hot_parents))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pairs.repartition(buckets, "parent").distinct()
    writer = rows.write.format("parquet").bucketBy(buckets, "parent").sortBy("parent")
    before = spark.conf.get(_SORTED)
    writer.option("path", scratch_path(spark, "edges")).saveAsTable(name)
    spark.conf.set(_SORTED, "true")  # one file per bucket: what is read is sorted
    try:
        yield _Edges(spark.table(name), hot, hot_parents)
    finally:
        spark.conf.set(_SORTED, before)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _children(stored: _Edges, frontier: DataFrame) -> DataFrame:
    return stored.leaving(frontier.select("node")).select(F.col("child").alias("node")).distinct()


def _together(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def closure(edge_table: DataFrame, starts: DataFrame) -> DataFrame:
    """All nodes reachable from `starts` (column node), the starts included.

    Ends on cyclic graphs too: a node seen once never enters the frontier again.
    `edge_table` is read twice; its repeated rows are harmless.
    """
    with _stored(edge_table) as stored:
        return _closure(stored, starts)


def _closure(stored: _Edges, starts: DataFrame) -> DataFrame:
    frontier = settle(starts.select("node").distinct())
    seen, n_seen = [frontier.frame], frontier.rows
    while True:
        reached = _children(stored, frontier.frame)
        if n_seen > _WIDE_FRONTIER * frontier.rows:
            # Few new nodes against many known ones: settle the few first, so that
            # the known ones need no shuffle.
            reached = settle(reached).frame
            known = _together(seen).join(reached, "node", "left_semi")
        else:
            known = _together(seen)
        frontier = settle(reached.join(known, "node", "left_anti"))
        if not frontier.rows:
            return _together(seen)
        seen.append(frontier.frame)
        n_seen += frontier.rows
        if len(seen) > 16:
            seen = [cut_lineage(_together(seen))]


def levels(edge_table: DataFrame, starts: DataFrame) -> DataFrame:
    """(node, level) for the closure of `starts`: the longest path from a start.

    A node comes after all its parents that lie in the closure, and nodes of one
    level do not depend on each other. Nodes on a cycle, or behind one, have no
    order: their level is NULL.

    A round's frontier holds the children of the last one, whether they came before or not;
    the last round that has a node is its level. In a graph that is deeper than _SHALLOW
    rounds, or cyclic, parents are counted instead, so that a node comes once.
    """
    with _stored(edge_table) as stored:
        frontier = settle(starts.select("node").distinct())
        rounds = []
        while frontier.rows and len(rounds) < _SHALLOW:
            rounds.append(frontier.frame.withColumn("level", F.lit(len(rounds))))
            frontier = settle(_children(stored, frontier.frame))
        if frontier.rows:
            return _counted_levels(stored, cut_lineage(_closure(stored, starts)))
        placed = _together(rounds) if rounds else frontier.frame.withColumn("level", F.lit(0))
        return cut_lineage(placed.groupBy("node").agg(F.max("level").alias("level")))


def _counted_levels(stored: _Edges, inside: DataFrame) -> DataFrame:
    """Every node's parents in the closure `inside` are counted once. A round tells the frontier's
    children how many parents have got a level; those that have all are the next frontier. Only edges
    that leave the frontier, and nodes some of whose parents are done, are looked at.
    """
    open_parents = cut_lineage(
        stored.leaving(inside).groupBy(F.col("child").alias("node")).agg(F.count(F.lit(1)).alias("parents"))
    )
    frontier = settle(inside.join(open_parents, "node", "left_anti"))
    done, level, partly = [], 0, None
    while frontier.rows:
        done.append(frontier.frame.withColumn("level", F.lit(level)))
        leaving = stored.leaving(frontier.frame.select("node"))
        told = leaving.groupBy(F.col("child").alias("node")).agg(F.count(F.lit(1)).alias("n"))
        if partly is not None:
            told = partly.unionByName(told).groupBy("node").agg(F.sum("n").alias("n"))
        judged = cut_lineage(told.join(open_parents, "node"))
        frontier = measured(judged.where("n = parents").select("node"))
        partly = judged.where("n < parents").select("node", "n")
        level += 1
        if level % 16 == 0:
            done = [cut_lineage(_together(done))]
    placed = _together(done) if done else inside.select("node", F.lit(0).alias("level")).limit(0)
    behind = open_parents.select("node").join(placed, "node", "left_anti")
    return placed.union(behind.select("node", F.lit(None).cast("int").alias("level")))


def impact(edge_table: DataFrame, starts: DataFrame, failed: DataFrame) -> DataFrame:
    """(node, status): done, failed, or blocked because something above it failed.

    A failed node that sits below another failed node was never run: blocked. One traversal
    carries along whether something above has failed; a node comes again at most once, when
    that is found out after it was seen.
    """
    broken = settle(failed.select("node").distinct().withColumn("broken", F.lit(True))).frame

    def known_broken(frontier: DataFrame) -> DataFrame:
        return frontier.join(broken, "node", "left").select(
            "node", "below", F.coalesce("broken", F.lit(False)).alias("broken")
        )

    with _stored(edge_table) as stored:
        frontier = settle(known_broken(starts.select("node").distinct().withColumn("below", F.lit(False))))
        seen = [frontier.frame]
        while frontier.rows:
            told = stored.leaving(frontier.frame.select("node", (F.col("below") | F.col("broken")).alias("below")))
            reached = told.groupBy(F.col("child").alias("node")).agg(F.max("below").alias("below"))
            known = _together(seen).select(F.col("node").alias("n"), F.col("below").alias("b"))
            new = reached.join(known, (F.col("node") == F.col("n")) & (F.col("b") | ~F.col("below")), "left_anti")
            frontier = settle(known_broken(new))
            seen.append(frontier.frame)
            if len(seen) > 16:
                seen = [cut_lineage(_together(seen))]
        marked = _together(seen).groupBy("node").agg(F.max("below").alias("below"), F.max("broken").alias("broken"))
        status = F.when(F.col("below"), F.lit("blocked")).when(F.col("broken"), F.lit("failed")).otherwise(F.lit("done"))
        return cut_lineage(marked.select("node", status.alias("status")))
