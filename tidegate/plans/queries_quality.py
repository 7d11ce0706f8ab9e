"""Quality rules, quarantine, names, typing and schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.names import clean_major_name, clean_name, node_id, qualified_name
from tidegate.functions.parse import parse_text
from tidegate.operators import quality
from tidegate.operators.evolve import add_columns, align, drift_report
from tidegate.operators.quality import Accepted, NotNull, References, Unique, Where
from tidegate.plans.registry import registered, table

# Events as a file would give them: the value as text, unreadable for errors.
RULES = (
    NotNull("value"),
    Accepted("event_type", ("click", "view", "purchase", "error")),
    Where("large_value", "value > 100"),
    Unique("slot"),
)


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their value typed from text; a day is a file, a minute is a slot."""
    text = F.when(F.col("event_type") == "error", F.lit("abc")).otherwise(
        F.col("value").cast("decimal(18,2)").cast("string")
    )
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        text.alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("slot"),
        F.lit(0).alias("increment"),
    )
    return parse_text(events, T.StructType([T.StructField("value", T.DecimalType(18, 2))]))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.mark(staged_events(spark, sf_dir), RULES, scope=("day", "event_type"))


STAGED_SQL = """
    SELECT event_id, event_type,
           TRY_CAST(CASE WHEN event_type = 'error' THEN 'abc' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END
                    AS DECIMAL(18,2)) AS value,
           strftime(ts, '%Y-%m-%d') AS day, date_trunc('minute', ts) AS slot, 0 AS increment
    FROM events"""
MARKED_SQL = f"""
    SELECT *, concat_ws(';', CASE WHEN value IS NULL THEN 'not_null(value)' END,
                 CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'error') THEN 'accepted_values(event_type)' END,
                 CASE WHEN value > 100 THEN 'large_value' END,
                 CASE WHEN slot IS NOT NULL AND count(*) OVER (PARTITION BY day, event_type, slot) > 1 THEN 'unique(slot)' END
             ) AS failed
    FROM ({STAGED_SQL})"""


def _flat(marked: DataFrame) -> DataFrame:
    return marked.withColumn("failed", F.array_join(quality.FAILED, ";")).drop(quality.FAILED)


@registered("quality_mark", MARKED_SQL)
def quality_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_marked(spark, sf_dir))


@registered("quality_mark_measured", MARKED_SQL)
def quality_mark_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same marks; duplicate values are computed first and broadcast if few."""
    return _flat(quality.mark(staged_events(spark, sf_dir), RULES, scope=("day", "event_type"), measured=True))


@registered(
    "quality_verdict",
    f"""SELECT day, event_type, count(*) AS rows_read, count(*) FILTER (failed <> '') AS rows_failed,
               count(*) FILTER (failed <> '') = 0 AS success
        FROM ({MARKED_SQL}) GROUP BY 1, 2""",
)
def quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdict(_marked(spark, sf_dir), ["day", "event_type"])


@registered(
    "quality_failures",
    f"""SELECT day, rule, count(*) AS rows_failed
        FROM (SELECT day, unnest(string_split(failed, ';')) AS rule FROM ({MARKED_SQL}) WHERE failed <> '') GROUP BY 1, 2""",
)
def quality_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failures(_marked(spark, sf_dir), ["day"])


@registered("quarantine_clean", f"SELECT * EXCLUDE (failed) FROM ({MARKED_SQL}) WHERE failed = ''")
def quarantine_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_rows(_marked(spark, sf_dir))


@registered("quarantine_review", f"SELECT * FROM ({MARKED_SQL}) WHERE failed <> ''")
def quarantine_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(quality.review_rows(_marked(spark, sf_dir)))


@registered(
    "failing_rows",
    f"""SELECT * FROM ({STAGED_SQL}) WHERE value IS NULL
        OR event_type NOT IN ('click', 'view', 'purchase', 'error') OR value > 100""",
)
def failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row rules alone, as one OR of predicates."""
    return staged_events(spark, sf_dir).where(quality.failing_any(RULES[:3]))


@registered(
    "requeue_fixed",
    f"""SELECT m.event_id, m.event_type, CASE WHEN e.event_id IS NOT NULL THEN CAST(e.value AS DECIMAL(18,2)) ELSE m.value END AS value,
               m.day, m.slot, m.increment + 1 AS increment
        FROM ({MARKED_SQL}) m LEFT JOIN (SELECT event_id, value FROM events WHERE event_type = 'error') e
          ON m.event_id = e.event_id
        WHERE m.failed <> ''""",
)
def requeue_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows as the next attempt, unreadable values corrected."""
    fixes = (
        table(spark, sf_dir, "events")
        .where("event_type = 'error'")
        .select("event_id", F.col("value").cast("decimal(18,2)").alias("value"))
    )
    return quality.requeue(quality.review_rows(_marked(spark, sf_dir)), fixes, "event_id")


@registered(
    "quality_unique",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS repeated
       FROM lineitem""",
)
def quality_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers that an order uses more than once."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    marked = quality.mark(lines, [Unique("l_linenumber")], scope=("l_orderkey",))
    return marked.withColumn("repeated", F.size(quality.FAILED) > 0).drop(quality.FAILED)


@registered(
    "quality_relationship",
    """SELECT l.*, (l.l_partkey IS NOT NULL AND NOT EXISTS
                    (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 25)) AS orphan
       FROM lineitem l""",
)
def quality_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose part is not among the small parts."""
    small = table(spark, sf_dir, "part").where("p_size <= 25")
    marked = quality.mark(table(spark, sf_dir, "lineitem"), [References("l_partkey", small, "p_partkey")])
    return marked.withColumn("orphan", F.size(quality.FAILED) > 0).drop(quality.FAILED)


# Characters Unicode calls white space, and four control characters that count as such.
_SPACES = "||".join(
    f"chr({c})"
    for c in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)
_NAME = f"translate(trim({{0}}, {_SPACES}), ' {{{{}}}}()' || chr(9) || '=,;' || chr(10), '_[][]_-')"
NAME_SQL = _NAME.format


@registered("normalise_names", f"SELECT doc_id, {NAME_SQL('text')} AS name FROM documents")
def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifier rules over whole texts, as raw names full of forbidden characters."""
    return table(spark, sf_dir, "documents").select("doc_id", clean_name("text").alias("name"))


_PART_NAME = "' ' || p_name || chr(9) || '(' || p_brand || '; ' || p_type || ')' || chr(10)"


@registered(
    "normalise_major_names",
    f"""SELECT p_partkey, replace({NAME_SQL(_PART_NAME)}, '-', '_') AS major,
               replace({NAME_SQL("'-' || p_brand || '='")}, '-', '_') || '.' || {NAME_SQL(_PART_NAME)} AS full_name
        FROM part""",
)
def normalise_major_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(
        F.lit(" "), "p_name", F.lit("\t("), "p_brand", F.lit("; "), "p_type", F.lit(")\n")
    )
    database = F.concat(F.lit("-"), "p_brand", F.lit("="))
    return table(spark, sf_dir, "part").select(
        "p_partkey", clean_major_name(raw).alias("major"), qualified_name(database, raw).alias("full_name")
    )


@registered(
    "node_ids",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'model.shop.' || c_name
                              ELSE 'source.shop.' || c_mktsegment || '.' || c_name END AS node FROM customer""",
)
def node_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("c_acctbal") < 0, F.lit("model")).otherwise(F.lit("source"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", node_id(kind, F.lit("shop"), "c_mktsegment", "c_name").alias("node")
    )


ORDER_TEXT = """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'abc' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'True' ELSE CAST(o_custkey AS VARCHAR) END AS volume,
           CASE WHEN o_orderstatus = 'F' THEN '6' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS height,
           CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS good
    FROM orders"""


def order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, each column unreadable for some of them."""
    status, urgency = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(urgency == "1-URGENT", "abc")
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .alias("price"),
        F.when(urgency == "5-LOW", "True").otherwise(F.col("o_custkey").cast("string")).alias("volume"),
        F.when(status == "F", "6").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("height"),
        F.when(status == "O", "").when(status == "F", "True").otherwise("False").alias("good"),
    )


TYPED = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("price", T.DecimalType(18, 9)),
        T.StructField("volume", T.IntegerType()),
        T.StructField("height", T.TimestampType()),
        T.StructField("good", T.BooleanType()),
    ]
)


@registered(
    "typed_parse",
    f"""SELECT o_orderkey, TRY_CAST(day AS DATE) AS day, TRY_CAST(price AS DECIMAL(18,9)) AS price,
               TRY_CAST(volume AS INTEGER) AS volume, TRY_CAST(height AS TIMESTAMP) AS height, TRY_CAST(good AS BOOLEAN) AS good
        FROM ({ORDER_TEXT})""",
)
def typed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_text(order_text(spark, sf_dir), TYPED, "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")
    return parsed.withColumn("height", F.col("height").cast("timestamp_ntz"))


WANTED = T.StructType(
    [
        T.StructField("C_CUSTKEY", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.LongType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
        T.StructField("c_since", T.DateType()),
    ]
)


@registered(
    "schema_align",
    """SELECT c_custkey AS "C_CUSTKEY", c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
              CAST(NULL AS VARCHAR) AS c_mktsegment, CAST(NULL AS DATE) AS c_since FROM customer""",
)
def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), WANTED)


@registered(
    "schema_add_columns",
    """SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment,
              CAST(NULL AS DATE) AS c_since FROM customer""",
)
def schema_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_columns(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), WANTED)


@registered(
    "drift_report",
    """SELECT d.*, n.table_rows FROM (VALUES
         ('c_acctbal', 'missing', CAST(NULL AS VARCHAR), 'double'), ('c_since', 'missing', NULL, 'date'),
         ('c_nationkey', 'type', 'int', 'bigint'), ('c_phone', 'extra', 'string', NULL))
         d("column", issue, table_type, wanted_type),
         (SELECT count(*) AS table_rows FROM customer) n""",
)
def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "customer").withColumn("c_phone", F.col("c_name")).drop("c_acctbal")
    return drift_report(held, WANTED)
