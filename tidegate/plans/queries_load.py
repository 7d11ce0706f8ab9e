"""Load strategies, row-level changes and history over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.marks import with_lineage
from tidegate.operators import history
from tidegate.operators.dedup import from_one_file, latest_per_key
from tidegate.operators.dml import delete_matching, delete_where, matching, new, update_from, update_where
from tidegate.operators.merge import load, merge
from tidegate.plans.registry import registered, table
from tidegate.session import cut_lineage, scratch_path
from tidegate.sources import tables

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def restated(orders: DataFrame) -> DataFrame:
    """Every order as a later file gives it: pending ones under a new key, urgent ones dearer."""
    return orders.withColumns(
        {
            "o_orderkey": F.when(F.col("o_orderstatus") == "P", -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")),
            "o_totalprice": F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 10).otherwise(
                F.col("o_totalprice")
            ),
        }
    )


RESTATED_SQL = """
    SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey,
           o_custkey, o_orderstatus,
           CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders"""

CHANGED_SQL = """(t.o_custkey IS DISTINCT FROM i.o_custkey OR t.o_orderstatus IS DISTINCT FROM i.o_orderstatus
      OR t.o_totalprice IS DISTINCT FROM i.o_totalprice OR t.o_orderdate IS DISTINCT FROM i.o_orderdate
      OR t.o_orderpriority IS DISTINCT FROM i.o_orderpriority)"""


def _picked(columns: tuple[str, ...]) -> str:
    return ",\n           ".join(
        f"CASE WHEN t.o_orderkey IS NULL OR (i.o_orderkey IS NOT NULL AND {CHANGED_SQL}) THEN i.{c} ELSE t.{c} END AS {c}"
        for c in columns
    )


UPDATE_SQL = f"""
    WITH t AS (SELECT *, 0 AS _load FROM orders),
         i AS (SELECT *, 1 AS _load FROM ({RESTATED_SQL}))
    SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey,
           {_picked((*ORDER_COLUMNS[1:], "_load"))},
           CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN i.o_orderkey IS NULL THEN 'keep'
                WHEN {CHANGED_SQL} THEN 'update' ELSE 'unchanged' END AS _change
    FROM t FULL JOIN i ON t.o_orderkey = i.o_orderkey"""


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("_load", F.lit(0)), restated(orders).withColumn("_load", F.lit(1))


@registered("merge_update", UPDATE_SQL)
def merge_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, incoming = _both(spark, sf_dir)
    return merge(target, incoming, "o_orderkey", "merge_update", change_column="_change")


@registered("change_counts", f"SELECT _change, count(*) AS n FROM ({UPDATE_SQL}) GROUP BY _change")
def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_update(spark, sf_dir).groupBy("_change").agg(F.count(F.lit(1)).alias("n"))


@registered(
    "merge_insert",
    f"""
    WITH i AS (SELECT *, 1 AS _load FROM ({RESTATED_SQL}))
    SELECT *, 0 AS _load FROM orders
    UNION ALL
    SELECT * FROM i WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = i.o_orderkey)""",
)
def merge_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, incoming = _both(spark, sf_dir)
    return merge(target, incoming, "o_orderkey", "merge_insert")


@registered(
    "merge_date_rows",
    f"""
    WITH t AS (SELECT * FROM orders),
         i AS ({RESTATED_SQL})
    SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey,
           {_picked(ORDER_COLUMNS[1:])},
           CASE WHEN t.o_orderkey IS NULL THEN TIMESTAMP '2024-06-01' ELSE t.o_orderdate END AS _date_row_inserted,
           CASE WHEN t.o_orderkey IS NOT NULL AND i.o_orderkey IS NOT NULL AND {CHANGED_SQL}
                THEN TIMESTAMP '2024-06-01' END AS _date_row_updated
    FROM t FULL JOIN i ON t.o_orderkey = i.o_orderkey""",
)
def merge_date_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    never, at = F.lit(None).cast("timestamp_ntz"), F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    target = orders.withColumns({"_date_row_inserted": F.col("o_orderdate"), "_date_row_updated": never})
    incoming = restated(orders).withColumns({"_date_row_inserted": at, "_date_row_updated": at})
    return merge(target, incoming, "o_orderkey", "merge_date_rows")


@registered(
    "merge_null_keys",
    """
    WITH t AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS o_orderkey,
                      o_custkey, o_totalprice, 0 AS _load FROM orders),
         i AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS o_orderkey,
                      o_custkey, o_totalprice + 10 AS o_totalprice, 1 AS _load FROM orders)
    SELECT t.o_orderkey, t.o_custkey,
           CASE WHEN i.o_orderkey IS NULL THEN t.o_totalprice ELSE i.o_totalprice END AS o_totalprice,
           CASE WHEN i.o_orderkey IS NULL THEN t._load ELSE i._load END AS _load
    FROM t LEFT JOIN i ON t.o_orderkey = i.o_orderkey
    UNION ALL
    SELECT i.* FROM i WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = i.o_orderkey)""",
)
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the keys NULL on both sides: none matches, all incoming ones are added."""
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select(key.alias("o_orderkey"), "o_custkey", "o_totalprice")
    incoming = orders.withColumn("o_totalprice", F.col("o_totalprice") + 10)
    return merge(
        orders.withColumn("_load", F.lit(0)), incoming.withColumn("_load", F.lit(1)), "o_orderkey", "merge_update"
    )


@registered(
    "merge_composite_key",
    """
    WITH i AS (SELECT l_orderkey, l_linenumber, max(l_discount) AS l_discount FROM lineitem GROUP BY 1, 2
               UNION ALL
               SELECT l_orderkey, 0, max(l_discount) FROM lineitem GROUP BY 1)
    SELECT coalesce(t.l_orderkey, i.l_orderkey) AS l_orderkey, t.l_partkey, t.l_suppkey,
           coalesce(t.l_linenumber, i.l_linenumber) AS l_linenumber, t.l_quantity, t.l_extendedprice,
           i.l_discount, t.l_tax, t.l_returnflag, t.l_linestatus, t.l_shipdate
    FROM lineitem t FULL JOIN i ON t.l_orderkey = i.l_orderkey AND t.l_linenumber = i.l_linenumber""",
)
def merge_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-part key that table rows repeat, and incoming rows with some of the columns only."""
    lines = table(spark, sf_dir, "lineitem")
    best = F.max("l_discount").alias("l_discount")
    per_line = lines.groupBy("l_orderkey", "l_linenumber").agg(best)
    per_order = lines.groupBy("l_orderkey").agg(best).withColumn("l_linenumber", F.lit(0))
    # Staged first, as a batch is: the merge reads its incoming rows more than once.
    staged = cut_lineage(per_line.unionByName(per_order))
    return merge(lines, staged, "l_orderkey,l_linenumber", "merge_update")


@registered(
    "merge_latest",
    """
    WITH i AS (SELECT l_orderkey, l_shipdate FROM (
                 SELECT l_orderkey, l_shipdate, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS rn
                 FROM lineitem) WHERE rn = 1)
    SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice,
           coalesce(i.l_shipdate, t.o_orderdate) AS o_orderdate, t.o_orderpriority
    FROM orders t LEFT JOIN i ON t.o_orderkey = i.l_orderkey""",
)
def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many incoming rows per key, the last one counts: each order moves to its last shipping date."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("o_orderdate")
    )
    return merge(
        table(spark, sf_dir, "orders"),
        lines,
        ["o_orderkey"],
        "merge_update",
        on_duplicate="latest",
        order_by=["o_orderdate"],
    )


@registered(
    "merge_present_columns",
    """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE NULL END AS o_orderpriority,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE o_totalprice + 10 END AS o_totalprice
    FROM orders""",
)
def merge_present_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that lack a column leave it alone: pending rows had no price, final ones no priority."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    has = (
        F.when(F.col("o_orderstatus") == "P", F.array(F.lit("o_custkey"), F.lit("o_orderpriority")))
        .when(F.col("o_orderstatus") == "F", F.array(F.lit("o_custkey"), F.lit("o_totalprice")))
        .otherwise(F.array(F.lit("o_custkey"), F.lit("o_orderpriority"), F.lit("o_totalprice")))
    )
    incoming = orders.select(
        "o_orderkey",
        "o_custkey",
        F.lit(None).cast("string").alias("o_orderpriority"),
        (F.col("o_totalprice") + 10).alias("o_totalprice"),
        has.alias("_present"),
    )
    return merge(orders.drop("o_orderstatus"), incoming, "o_orderkey", "merge_update", present="_present")


@registered("load_append", f"SELECT * FROM orders UNION ALL ({RESTATED_SQL})")
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return load(orders, restated(orders), "insert")


@registered("load_replace", RESTATED_SQL)
def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return load(orders, restated(orders), "replace")


@registered(
    "lineage_columns",
    "SELECT *, TIMESTAMP '2024-06-01' AS _datetime_added, o_orderkey AS _hash FROM orders",
)
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.lit("2024-06-01 00:00:00").cast("timestamp")
    rows = with_lineage(table(spark, sf_dir, "orders"), F.col("o_orderkey"), at)
    return rows.withColumn("_datetime_added", F.col("_datetime_added").cast("timestamp_ntz"))


@registered(
    "publish_and_append",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_totalprice, NULL FROM orders WHERE o_orderstatus = 'P'""",
)
def publish_and_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published, published again from itself with one more column, then appended to."""
    root = scratch_path(spark, "publish")
    name = "tidegate_" + root.rsplit("-", 1)[-1]
    orders = table(spark, sf_dir, "orders")
    tables.publish(spark, name, orders.select("o_orderkey", "o_custkey", "o_totalprice"), root)
    wider = tables.read(spark, name).join(orders.select("o_orderkey", "o_orderpriority"), "o_orderkey", "left")
    tables.publish(spark, name, wider, root)
    added = orders.where("o_orderstatus = 'P'").select(
        (-F.col("o_orderkey") - 1).alias("o_orderkey"),
        F.lit(None).cast("string").alias("o_orderpriority"),
        "o_custkey",
        "o_totalprice",
    )
    tables.append(spark, name, added)
    return tables.read(spark, name)


@registered(
    "delete_matching",
    """SELECT l.* FROM lineitem l
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'P')""",
)
def delete_pending_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    doomed = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return delete_matching(table(spark, sf_dir, "lineitem"), doomed, "l_orderkey")


@registered(
    "deleted_rows",
    """SELECT l.* FROM lineitem l
       WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'P')""",
)
def deleted_pending_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    doomed = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return matching(table(spark, sf_dir, "lineitem"), doomed, "l_orderkey")


@registered(
    "update_where",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_discount END AS l_discount, l_tax,
           CASE WHEN l_returnflag = 'R' THEN 'N' ELSE l_returnflag END AS l_returnflag, l_linestatus, l_shipdate
    FROM lineitem""",
)
def update_returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return update_where(
        table(spark, sf_dir, "lineitem"),
        F.col("l_returnflag") == "R",
        {"l_discount": F.lit(0.0), "l_returnflag": F.lit("N")},
    )


@registered(
    "update_from_batch",
    """
    SELECT c.c_custkey, c.c_name, c.c_nationkey, coalesce(c.c_acctbal + u.top, c.c_acctbal) AS c_acctbal, c.c_mktsegment
    FROM customer c LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY 1) u
      ON c.c_custkey = u.o_custkey""",
)
def update_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    tops = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("top"))
    )
    changes = {"c_acctbal": F.col("c_acctbal") + new("top")}
    return update_from(table(spark, sf_dir, "customer"), tops, "c_custkey", changes)


@registered(
    "delete_where",
    """SELECT * FROM events
       WHERE NOT coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) > 50 AND event_type = 'error', FALSE)""",
)
def delete_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    return delete_where(table(spark, sf_dir, "events"), (k > 50) & (F.col("event_type") == "error"))


LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
)


@registered(
    "dedup_latest",
    f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {", ".join(f"{c} DESC" for c in LINE_ORDER)}) AS rn FROM lineitem)
    WHERE rn = 1""",
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)


@registered(
    "last_file_wins",
    """
    SELECT l.* FROM lineitem l
    JOIN (SELECT l_orderkey, max(l_shipdate) AS last FROM lineitem GROUP BY 1) w
      ON l.l_orderkey = w.l_orderkey AND l.l_shipdate = w.last""",
)
def last_file_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipping days as files of one batch: for each order, the rows of its last file stay."""
    return from_one_file(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_shipdate"], "latest")


@registered(
    "rows_per_key",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def rows_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@registered("top_k", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@registered(
    "load_difference",
    f"SELECT * FROM orders EXCEPT ALL ({RESTATED_SQL})",
)
def load_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first load that the second does not hold, copies counted."""
    orders = table(spark, sf_dir, "orders")
    return orders.exceptAll(restated(orders))


T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def _at(text: str):
    return F.lit(text).cast("timestamp")


def _plain_times(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (history.VALID_FROM, history.VALID_TO)})


@registered(
    "history_snapshot",
    f"""
    WITH i AS ({RESTATED_SQL})
    SELECT t.*, TIMESTAMP '{T1}' AS _valid_from,
           CASE WHEN i.o_orderkey IS NOT NULL AND {CHANGED_SQL} THEN TIMESTAMP '{T2}' END AS _valid_to
    FROM orders t LEFT JOIN i ON t.o_orderkey = i.o_orderkey
    UNION ALL
    SELECT i.*, TIMESTAMP '{T2}', NULL
    FROM i LEFT JOIN orders t ON t.o_orderkey = i.o_orderkey WHERE t.o_orderkey IS NULL OR {CHANGED_SQL}""",
)
def history_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    first = history.begin(orders, _at(T1))
    return _plain_times(history.snapshot(first, restated(orders), "o_orderkey", _at(T2)))


@registered(
    "history_three_states",
    f"""
    WITH i AS ({RESTATED_SQL}),
         moved AS (SELECT t.o_orderkey AS k FROM orders t JOIN i ON t.o_orderkey = i.o_orderkey WHERE {CHANGED_SQL})
    SELECT o.*, TIMESTAMP '{T1}' AS _valid_from, CASE WHEN m.k IS NOT NULL THEN TIMESTAMP '{T2}' END AS _valid_to
    FROM orders o LEFT JOIN moved m ON o.o_orderkey = m.k
    UNION ALL
    SELECT i.*, TIMESTAMP '{T2}', TIMESTAMP '{T3}' FROM i JOIN moved m ON i.o_orderkey = m.k
    UNION ALL
    SELECT o.*, TIMESTAMP '{T3}', NULL FROM orders o JOIN moved m ON o.o_orderkey = m.k
    UNION ALL
    SELECT i.*, TIMESTAMP '{T2}', NULL FROM i WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = i.o_orderkey)""",
)
def history_three_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    second = history.snapshot(history.begin(orders, _at(T1)), restated(orders), "o_orderkey", _at(T2))
    return _plain_times(history.snapshot(second, orders, "o_orderkey", _at(T3)))
