"""Files end to end: orders written as delimited or JSON files, and read back under contract."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import TableContract
from tidegate.operators.quality import FAILED, NotNull, Unique, mark
from tidegate.plans.ingest import Store, ingest_batch, ingest_review
from tidegate.plans.registry import registered, table
from tidegate.session import scratch_path
from tidegate.sources.files import list_files
from tidegate.sources.headers import audit
from tidegate.sources.scan import FILE_NAME, HASH, INCREMENT, RECORD, read_files, scan, stage_files
from tidegate.streaming.arrivals import ingest_arrivals

COLUMNS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DecimalType(18, 2)),
        T.StructField("o_orderdate", T.TimestampType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
NAMES = COLUMNS.fieldNames()
CSV_OPTIONS = {"sep": ",", "header": True, "timestampFormat": "yyyy-MM-dd HH:mm:ss"}


def contract(source: str = "shop", columns: T.StructType = COLUMNS, **changes) -> TableContract:
    settings = {
        "keys": ("o_orderkey",),
        "strategy": "merge_update",
        "options": CSV_OPTIONS,
        "rules": (NotNull("o_orderkey"), Unique("o_orderkey"), NotNull("o_totalprice"), NotNull("o_orderdate")),
        **changes,
    }
    return TableContract(source=source, table="orders", columns=columns, **settings)


def as_text(orders: DataFrame) -> DataFrame:
    """Orders as file fields; urgent pending ones carry a price nobody can read."""
    broken = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(broken, F.lit("abc")).otherwise(price).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        "o_orderpriority",
    )


TYPED_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders"""


def _view(rows: DataFrame) -> DataFrame:
    return rows.select(*NAMES).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def _three_layouts(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Three folders: all columns; all in reverse order; all but the priority."""
    folder = scratch_path(spark, label)
    text = as_text(table(spark, sf_dir, "orders"))
    for status, names in {"F": NAMES, "O": NAMES[::-1], "P": NAMES[:-1]}.items():
        rows = text.where(F.col("o_orderstatus") == status).select(*names)
        rows.write.option("header", True).csv(f"{folder}/{status}")
    return folder


@registered("csv_scan", TYPED_SQL)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "csv")
    as_text(table(spark, sf_dir, "orders")).write.option("header", True).csv(folder)
    return _view(scan(spark, folder, contract()))


@registered("json_scan", TYPED_SQL)
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "json")
    as_text(table(spark, sf_dir, "orders")).write.json(folder)
    options = {"type": "json", "timestampFormat": "yyyy-MM-dd HH:mm:ss", "primitivesAsString": "false"}
    return _view(scan(spark, folder, contract(options=options)))


@registered(
    "csv_mixed_headers",
    f"SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority) FROM ({TYPED_SQL})",
)
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with columns in another order, or fewer, in one read."""
    folder = _three_layouts(spark, sf_dir, "mixed")
    rows, _ = read_files(spark, [f"{folder}/{s}" for s in "FOP"], contract())
    return _view(rows)


@registered(
    "header_audit",
    """SELECT DISTINCT CASE o_orderpriority WHEN '5-LOW' THEN 'twice' ELSE o_orderstatus END AS layout,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'O_CustKey' WHEN o_orderstatus = 'P' THEN '' ELSE 'o_orderpriority' END AS extra,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'o_orderkey,o_orderstatus,o_totalprice,o_orderdate,O_Clerk, the' ELSE 'O_Clerk, the' END AS absent,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'o_orderkey' ELSE '' END AS absent_keys,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'o_custkey' ELSE '' END AS repeated,
              o_orderpriority = '5-LOW' OR o_orderstatus <> 'P' AS refused
       FROM orders""",
)
def header_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file's header against a contract that lacks one column and has another.

    Four layouts; the last lacks the key and has a name twice but for its case.
    """
    folder = _three_layouts(spark, sf_dir, "audit")
    orders = as_text(table(spark, sf_dir, "orders")).where("o_orderpriority = '5-LOW'")
    twice = orders.select(F.concat_ws(",", "o_custkey", "o_custkey").alias("o_custkey,O_CustKey"))
    twice.write.option("header", True).option("sep", "|").option("quote", "").csv(f"{folder}/twice")
    narrower = T.StructType([*COLUMNS.fields[:-1], T.StructField("O_Clerk, the", T.StringType())])
    files = list_files(spark, [f"{folder}/{s}" for s in ("F", "O", "P", "twice")])
    judged = audit(files, contract(columns=narrower))
    return judged.select(
        F.element_at(F.split("path", "/"), -2).alias("layout"),
        *[F.array_join(c, ",").alias(c) for c in ("extra", "absent", "absent_keys", "repeated")],
        "refused",
    ).distinct()


@registered(
    "staged_files",
    f"""SELECT *, 0 AS increment, TRUE AS own_hash FROM ({TYPED_SQL})""",
)
def staged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows carry the attempt and the hash of their own file."""
    folder = scratch_path(spark, "stage")
    as_text(table(spark, sf_dir, "orders")).write.option("header", True).csv(folder)
    staged = stage_files(spark, folder, contract())
    own = F.col(HASH) == F.hash(F.lit("shop"), F.lit("orders"), F.col(FILE_NAME))
    view = staged.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    return view.select(*NAMES, F.col(INCREMENT).alias("increment"), own.alias("own_hash"))


def _fresh_store(spark: SparkSession, label: str) -> tuple[Store, str]:
    root = scratch_path(spark, label)
    mark = root.rsplit("-", 1)[-1]
    return Store(spark, root, f"orchestration_{mark}.import_file"), f"shop_{mark}"


@registered("ingest_files", f"SELECT * FROM ({TYPED_SQL}) WHERE o_totalprice IS NOT NULL")
def ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of files through register, audit, stage, test, quarantine and merge."""
    store, source = _fresh_store(spark, "ingest")
    folder = scratch_path(spark, "arrived")
    as_text(table(spark, sf_dir, "orders")).write.option("header", True).csv(folder)
    declared = contract(source)
    ingest_batch(store, declared, folder, "first", datetime(2024, 6, 1))
    return _view(store.table(declared))


@registered(
    "ingest_review",
    "SELECT * REPLACE (CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice) FROM orders",
)
def ingest_review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantined rows corrected and loaded as their next attempt: all orders arrive."""
    store, source = _fresh_store(spark, "review")
    folder = scratch_path(spark, "arrived")
    orders = table(spark, sf_dir, "orders")
    as_text(orders).write.option("header", True).csv(folder)
    declared = contract(source)
    ingest_batch(store, declared, folder, "first", datetime(2024, 6, 1))
    fixes = orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    ingest_review(store, declared, fixes, "o_orderkey", "second", datetime(2024, 6, 2))
    return _view(store.table(declared))


@registered("stream_ingest", f"SELECT * FROM ({TYPED_SQL}) WHERE o_totalprice IS NOT NULL")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as an arrival stream, in as many micro-batches as it takes."""
    store, source = _fresh_store(spark, "stream")
    folder = scratch_path(spark, "arrived")
    as_text(table(spark, sf_dir, "orders")).write.option("header", True).csv(folder)
    declared = contract(source)
    ingest_arrivals(store, declared, folder, store.path("checkpoint")).awaitTermination()
    return _view(store.table(declared))


@registered(
    "merge_partitioned",
    """SELECT o_orderkey, o_custkey, o_orderstatus,
              CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') AND o_orderkey % 10 <> 0
                   THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2)) AS o_totalprice,
              o_orderdate, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS o_orderpriority
       FROM orders""",
)
def merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table partitioned by priority (values with spaces, and NULL); two of its partitions change."""
    store, source = _fresh_store(spark, "parted")
    folder = scratch_path(spark, "arrived")
    declared = contract(source, keys=("o_orderpriority", "o_orderkey"), partition_by=("o_orderpriority",), rules=())
    priority = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("o_orderpriority")
    orders = table(spark, sf_dir, "orders").select(*NAMES[:-1], priority)
    text = orders.select(
        *NAMES[:3], F.col("o_totalprice").cast("decimal(18,2)"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), "o_orderpriority",
    )
    text.write.option("header", True).csv(f"{folder}/1")
    changed = text.where(F.col("o_orderpriority").isin("1-URGENT", "4-NOT SPECIFIED"))
    changed.withColumn("o_totalprice", F.col("o_totalprice") + 1).write.option("header", True).csv(f"{folder}/2")
    ingest_batch(store, declared, f"{folder}/1", "first", datetime(2024, 6, 1))
    ingest_batch(store, declared, f"{folder}/2", "second", datetime(2024, 6, 2))
    return _view(store.table(declared))


@registered(
    "replace_partitioned",
    """SELECT * REPLACE (CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice) FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""",
)
def replace_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table replaced by a file with fewer partitions."""
    store, source = _fresh_store(spark, "replaced")
    folder = scratch_path(spark, "arrived")
    declared = contract(
        source, keys=("o_orderpriority", "o_orderkey"), partition_by=("o_orderpriority",), rules=(), strategy="replace",
        delivery="folder",
    )
    text = table(spark, sf_dir, "orders").select(
        *NAMES[:3], F.col("o_totalprice").cast("decimal(18,2)"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), "o_orderpriority",
    )
    text.write.option("header", True).csv(f"{folder}/1")
    fewer = text.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    fewer.write.option("header", True).csv(f"{folder}/2")
    ingest_batch(store, declared, f"{folder}/1", "first", datetime(2024, 6, 1))
    ingest_batch(store, declared, f"{folder}/2", "second", datetime(2024, 6, 2))
    return _view(store.table(declared))


class _CutOff(Store):
    """A store whose batches break off after staging."""

    def step(self, step, contract, batch_id):
        if step == "marked":
            raise InterruptedError("cut off after staging")
        return super().step(step, contract, batch_id)


@registered("ingest_resumed", f"SELECT * FROM ({TYPED_SQL}) WHERE o_totalprice IS NOT NULL")
def ingest_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch cut off after staging, more files in its folder, and the same call twice more."""
    store, source = _fresh_store(spark, "resumed")
    folder = scratch_path(spark, "arrived")
    declared = contract(source)
    text = as_text(table(spark, sf_dir, "orders"))
    text.where("o_orderstatus = 'F'").write.option("header", True).csv(folder)
    try:
        ingest_batch(_CutOff(spark, store.root, store.ledger_name), declared, folder, "daily", datetime(2024, 6, 1))
    except InterruptedError:
        text.where("o_orderstatus != 'F'").write.mode("append").option("header", True).csv(folder)
    ingest_batch(store, declared, folder, "daily", datetime(2024, 6, 1))  # goes on with what was staged
    ingest_batch(store, declared, folder, "daily", datetime(2024, 6, 1))  # takes the files that came meanwhile
    return _view(store.table(declared))


def _reviewed(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    """Clean rows, then the corrected ones at the same load time."""
    store, source = _fresh_store(spark, strategy)
    folder = scratch_path(spark, "arrived")
    orders = table(spark, sf_dir, "orders")
    as_text(orders).write.option("header", True).csv(folder)
    declared = contract(source, strategy=strategy, delivery="folder")
    ingest_batch(store, declared, folder, "first", datetime(2024, 6, 1))
    fixes = orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    ingest_review(store, declared, fixes, "o_orderkey", "first", datetime(2024, 6, 1))
    return _view(store.table(declared))


ALL_ORDERS = "SELECT * REPLACE (CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice) FROM orders"


@registered("ingest_review_insert", ALL_ORDERS)
def ingest_review_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviewed(spark, sf_dir, "insert")


@registered("ingest_review_replace", ALL_ORDERS)
def ingest_review_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviewed(spark, sf_dir, "replace")


@registered(
    "contract_expressions",
    """SELECT o_orderkey, array_to_string(list_filter([
              CASE WHEN o_totalprice < 1000 THEN 'expression(`o_totalprice` >= 1000)' END,
              CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT' THEN 'pending is urgent' END,
              CASE WHEN NOT o_custkey + o_orderkey % 7 > 6 THEN 'expression(o_custkey + o_orderkey % 7 > 6)' END
              ], lambda n: n IS NOT NULL), ',') AS failed
       FROM orders""",
)
def contract_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free conditions on rows, written in a contract's mapping and checked against its columns."""
    declared = TableContract.from_mapping(
        "shop",
        {
            "name": "orders",
            "join": {"type": "insert", "column": "o_orderkey"},
            "columns": [
                {
                    "name": f.name,
                    "data_type": f.dataType.simpleString(),
                    "tests": [{"expression": ">= 1000"}] if f.name == "o_totalprice" else [],
                }
                for f in COLUMNS.fields
            ],
            "tests": [
                {"name": "pending is urgent", "expression": "o_orderstatus != 'P' OR o_orderpriority = '1-URGENT'"},
                {"expression": "o_custkey + o_orderkey % 7 > 6"},
            ],
        },
    )
    declared.check(spark)
    marked = mark(table(spark, sf_dir, "orders"), declared.rules)
    return marked.select("o_orderkey", F.array_join(FAILED, ",").alias("failed"))


@registered(
    "quarantined_records",
    """SELECT o_orderkey, o_orderkey || ',' || o_custkey || ',P,abc,' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ',1-URGENT' AS record
       FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'""",
)
def quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw record of every row that went to review because a field could not be read."""
    store, source = _fresh_store(spark, "records")
    folder = scratch_path(spark, "arrived")
    as_text(table(spark, sf_dir, "orders")).write.option("header", True).csv(folder)
    declared = contract(source)
    ingest_batch(store, declared, folder, "first", datetime(2024, 6, 1))
    return store.review(declared).select("o_orderkey", F.col(RECORD).alias("record"))
