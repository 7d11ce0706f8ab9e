"""Lineage over a graph of the order tables' rows: who depends on whom."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import lineage
from tidegate.plans.propagate import rebuild
from tidegate.plans.registry import registered, table
from tidegate.session import scratch_path


def node_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions and parts are sources; a line depends on its order, part and supplier.

    Tests depend on customers and are no part of the graph.
    """

    def named(prefix: str, *columns: str):
        return F.concat_ws("_", F.lit(prefix), *columns)

    def rows(name: str, kind: str, node, *parents) -> DataFrame:
        above = F.array(*parents) if parents else F.array().cast("array<string>")
        return table(spark, sf_dir, name).select(
            node.alias("unique_id"), F.lit(kind).alias("resource_type"), above.alias("depends_on")
        )

    parts = [
        rows("region", "source", named("region", "r_regionkey")),
        rows("part", "source", named("part", "p_partkey")),
        rows("nation", "model", named("nation", "n_nationkey"), named("region", "n_regionkey")),
        rows("customer", "model", named("customer", "c_custkey"), named("nation", "c_nationkey")),
        rows("customer", "test", named("test", "c_custkey"), named("customer", "c_custkey")),
        rows("supplier", "model", named("supplier", "s_suppkey"), named("nation", "s_nationkey")),
        rows("orders", "snapshot", named("order", "o_orderkey"), named("customer", "o_custkey")),
        rows(
            "lineitem", "model", named("line", "l_orderkey", "l_linenumber"),
            named("order", "l_orderkey"), named("part", "l_partkey"), named("supplier", "l_suppkey"),
        ),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


EDGES_SQL = """
    SELECT DISTINCT parent, child FROM (
      SELECT 'region_' || n_regionkey AS parent, 'nation_' || n_nationkey AS child FROM nation
      UNION ALL SELECT 'nation_' || c_nationkey, 'customer_' || c_custkey FROM customer
      UNION ALL SELECT 'nation_' || s_nationkey, 'supplier_' || s_suppkey FROM supplier
      UNION ALL SELECT 'customer_' || o_custkey, 'order_' || o_orderkey FROM orders
      UNION ALL SELECT 'order_' || l_orderkey, 'line_' || l_orderkey || '_' || l_linenumber FROM lineitem
      UNION ALL SELECT 'part_' || l_partkey, 'line_' || l_orderkey || '_' || l_linenumber FROM lineitem
      UNION ALL SELECT 'supplier_' || l_suppkey, 'line_' || l_orderkey || '_' || l_linenumber FROM lineitem)"""


@registered("lineage_edges", EDGES_SQL)
def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.edges(node_table(spark, sf_dir))


def _edge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges as the node table has them; a traversal stores the distinct ones, by parent."""
    return lineage.links(node_table(spark, sf_dir))


def _starts(spark: SparkSession, sf_dir: str, condition: str = "TRUE") -> DataFrame:
    regions = table(spark, sf_dir, "region").where(condition)
    return regions.select(F.concat_ws("_", F.lit("region"), "r_regionkey").alias("node"))


_REACH = """
    e AS ({edges}),
    reach(node) AS (SELECT 'region_' || r_regionkey FROM region WHERE {condition}
                    UNION SELECT e.child FROM reach JOIN e ON reach.node = e.parent)"""


@registered(
    "lineage_closure",
    f"""WITH RECURSIVE {_REACH.format(edges=EDGES_SQL, condition="r_name = 'ASIA'")} SELECT node FROM reach""",
)
def lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.closure(_edge_table(spark, sf_dir), _starts(spark, sf_dir, "r_name = 'ASIA'"))


@registered(
    "lineage_levels",
    f"""WITH RECURSIVE e AS ({EDGES_SQL}),
        path(node, level) AS (SELECT 'region_' || r_regionkey, 0 FROM region
                              UNION SELECT e.child, path.level + 1 FROM path JOIN e ON path.node = e.parent)
        SELECT node, max(level) AS level FROM path GROUP BY node""",
)
def lineage_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.levels(_edge_table(spark, sf_dir), _starts(spark, sf_dir))


@registered(
    "lineage_impact",
    f"""WITH RECURSIVE {_REACH.format(edges=EDGES_SQL, condition="TRUE")},
        broken(node) AS (SELECT 'nation_' || n_nationkey FROM nation WHERE n_name = 'NATION_3'
                         UNION ALL SELECT 'customer_' || c_custkey FROM customer WHERE c_acctbal < 0),
        below(node) AS (SELECT e.child FROM broken JOIN e ON broken.node = e.parent
                        UNION SELECT e.child FROM below JOIN e ON below.node = e.parent)
        SELECT r.node, CASE WHEN r.node IN (SELECT node FROM below) THEN 'blocked'
                            WHEN r.node IN (SELECT node FROM broken) THEN 'failed' ELSE 'done' END AS status
        FROM reach r""",
)
def lineage_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").where("n_name = 'NATION_3'")
    poor = table(spark, sf_dir, "customer").where("c_acctbal < 0")
    failed = nations.select(F.concat_ws("_", F.lit("nation"), "n_nationkey").alias("node")).unionByName(
        poor.select(F.concat_ws("_", F.lit("customer"), "c_custkey").alias("node"))
    )
    return lineage.impact(_edge_table(spark, sf_dir), _starts(spark, sf_dir), failed)


@registered(
    "model_rebuild",
    """SELECT c_nationkey, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def model_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dependent model, computed and materialised as a table."""
    root = scratch_path(spark, "model")
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    revenue = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("price").alias("revenue"))
    )
    return rebuild(spark, "tidegate_model_" + root.rsplit("-", 1)[-1], revenue, root)
