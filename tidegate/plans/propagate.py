"""Downstream refresh: tables that depend on a changed source, parents first."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.lineage import edges, levels
from tidegate.session import cut_lineage
from tidegate.sources import tables


class RefreshError(RuntimeError):
    """Some dependents failed; `status` says what became of every node."""

    def __init__(self, status: dict[str, str], errors: dict[str, Exception]) -> None:
        super().__init__(f"failed: {sorted(errors)}; status: {status}")
        self.status, self.errors = status, errors


def rebuild(spark, name: str, state: DataFrame, root: str) -> DataFrame:
    """Materialise a model's result as its table."""
    tables.publish(spark, name, state, root)
    return tables.read(spark, name)


def refresh(nodes: DataFrame, start: str, builders: Mapping[str, Callable[[], object]]) -> dict[str, str]:
    """Run the builder of every dependent of `start`, in dependency order.

    A dependent of a failed node is skipped, others go on; one error at the end names
    the failures. The node table describes models, of which there are few; the data
    work is in the builders.
    """
    spark = nodes.sparkSession
    links = cut_lineage(edges(nodes))
    placed = levels(links, spark.createDataFrame([(start,)], "node string"))
    parents = links.groupBy(F.col("child").alias("node")).agg(F.collect_set("parent").alias("parents"))
    plan = placed.join(parents, "node", "left").orderBy("level", "node").collect()
    cyclic = [row.node for row in plan if row.level is None]
    if cyclic:
        raise ValueError(f"nodes depend on each other in a circle: {cyclic}")
    inside = {row.node for row in plan}
    status, errors = {start: "done"}, {}
    for row in plan:
        if row.node == start:
            continue
        if any(status[p] != "done" for p in row.parents if p in inside):
            status[row.node] = "blocked"
            continue
        try:
            builders[row.node]()
            status[row.node] = "done"
        except Exception as error:  # the others still run
            status[row.node] = "failed"
            errors[row.node] = error
    if errors:
        raise RefreshError(status, errors)
    return status
