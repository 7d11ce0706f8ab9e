"""The import ledger over orders: every order is a file, its lines are the file's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.marks import STAGES, file_hash, stage_rank, stamp_column
from tidegate.functions.names import review_id, staged_id
from tidegate.operators import ledger as book
from tidegate.plans.registry import registered, table
from tidegate.sources.files import missing_files

AT = "2024-06-01 00:00:00"
_STAMPS = [stamp_column(s) for s in STAGES]
_TIMES = [*_STAMPS, "_date_row_inserted", "_date_row_updated"]


def _at():
    return F.lit(AT).cast("timestamp")


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"),
        F.concat(F.lit("orders_"), F.lower("o_orderstatus")).alias("table"),
        F.concat(F.lit("order_"), "o_orderkey", F.lit(".csv")).alias("file_name"),
        "o_orderkey",
        "o_orderstatus",
        "o_orderdate",
    )


def order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final orders are completed, open ones staged, pending ones new.

    Each final order that is urgent has a second attempt, which is staged.
    """
    files = order_files(spark, sf_dir).withColumn("start", F.col("o_orderdate").cast("timestamp"))
    first = files.withColumn("increment", F.lit(0)).withColumn(
        "steps", F.when(F.col("o_orderstatus") == "F", 6).when(F.col("o_orderstatus") == "O", 3).otherwise(1)
    )
    second = (
        files.where("o_orderstatus = 'F' AND source = '1-URGENT'")
        .withColumn("increment", F.lit(1))
        .withColumn("steps", F.lit(3))
    )
    never = F.lit(None).cast("timestamp")
    return first.unionByName(second).select(
        file_hash(*book.FILE).alias("hash"),
        *book.FILE,
        F.lit(None).cast("string").alias("processed_file_name"),
        "increment",
        *[
            F.when(F.col("steps") > i, F.col("start") + F.expr(f"INTERVAL '{i}' DAY")).otherwise(never).alias(c)
            for i, c in enumerate(_STAMPS)
        ],
        F.lit(None).cast("int").alias("rows_read"),
        F.col("start").alias("_date_row_inserted"),
        never.alias("_date_row_updated"),
    )


_FILE_SQL = """o_orderpriority AS source, 'orders_' || lower(o_orderstatus) AS "table",
           'order_' || o_orderkey || '.csv' AS file_name"""
_STEPS = ",\n           ".join(
    f"CASE WHEN steps > {i} THEN o_orderdate + INTERVAL {i} DAY END AS {c}" for i, c in enumerate(_STAMPS)
)
LEDGER_SQL = f"""
    SELECT {_FILE_SQL},
           CAST(NULL AS VARCHAR) AS processed_file_name, increment, {_STEPS},
           CAST(NULL AS INTEGER) AS rows_read, o_orderdate AS _date_row_inserted, CAST(NULL AS TIMESTAMP) AS _date_row_updated
    FROM (SELECT *, 0 AS increment, CASE o_orderstatus WHEN 'F' THEN 6 WHEN 'O' THEN 3 ELSE 1 END AS steps FROM orders
          UNION ALL
          SELECT *, 1, 3 FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')"""
_KEY_MATCH = 'l.source = x.source AND l."table" = x."table" AND l.file_name = x.file_name AND l.increment = x.increment'


def _view(ledger: DataFrame) -> DataFrame:
    """For comparison: stamps without zone, and no hash, which SQL has no function for."""
    return ledger.drop("hash").withColumns({c: F.col(c).cast("timestamp_ntz") for c in _TIMES if c in ledger.columns})


@registered("ledger_entries", LEDGER_SQL)
def ledger_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(order_ledger(spark, sf_dir))


_REGISTER_FILES = f"""
    SELECT {_FILE_SQL}, 0 AS increment FROM orders
    UNION ALL SELECT {_FILE_SQL}, 1 FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT {_FILE_SQL}, 3 FROM orders WHERE o_orderpriority = '1-URGENT'"""


def _to_register(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A ledger of all but the pending orders, and files of all orders and several attempts."""
    ledger = order_ledger(spark, sf_dir).where("date_staged IS NOT NULL")
    files = order_files(spark, sf_dir)
    attempts = (
        files.withColumn("increment", F.lit(0))
        .unionByName(files.where("o_orderstatus <> 'P'").withColumn("increment", F.lit(1)))
        .unionByName(files.where("source = '1-URGENT'").withColumn("increment", F.lit(3)))
    )
    return ledger, attempts.select(*book.ENTRY)


@registered(
    "ledger_register",
    f"""
    WITH l AS (SELECT * FROM ({LEDGER_SQL}) WHERE date_staged IS NOT NULL),
         x AS (SELECT * FROM ({_REGISTER_FILES}) f WHERE f.increment = 0 OR EXISTS (
                 SELECT 1 FROM l WHERE l.source = f.source AND l."table" = f."table" AND l.file_name = f.file_name
                 AND l.increment = f.increment - 1))
    SELECT * FROM l
    UNION ALL
    SELECT source, "table", file_name, NULL, increment, TIMESTAMP '{AT}', NULL, NULL, NULL, NULL, NULL, NULL,
           TIMESTAMP '{AT}', NULL
    FROM x WHERE NOT EXISTS (SELECT 1 FROM l WHERE {_KEY_MATCH})""",
)
def ledger_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger, files = _to_register(spark, sf_dir)
    return _view(book.register(ledger, files, _at()).ledger)


@registered(
    "ledger_gap",
    f"""
    WITH l AS (SELECT * FROM ({LEDGER_SQL}) WHERE date_staged IS NOT NULL)
    SELECT * FROM ({_REGISTER_FILES}) f WHERE f.increment > 0 AND NOT EXISTS (
      SELECT 1 FROM l WHERE l.source = f.source AND l."table" = f."table" AND l.file_name = f.file_name
      AND l.increment = f.increment - 1)""",
)
def ledger_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger, files = _to_register(spark, sf_dir)
    return book.register(ledger, files, _at()).rejected


@registered(
    "ledger_missing_entries",
    f"""SELECT source, "table", file_name, increment FROM (SELECT {_FILE_SQL}, 1 AS increment FROM orders) x
        WHERE NOT EXISTS (SELECT 1 FROM ({LEDGER_SQL}) l WHERE {_KEY_MATCH})""",
)
def ledger_missing_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = order_files(spark, sf_dir).select(*book.FILE, F.lit(1).alias("increment"))
    return book.missing_entries(order_ledger(spark, sf_dir), files)


_STAGE_SQL = """CASE WHEN date_completed IS NOT NULL THEN 'completed' WHEN date_inserted IS NOT NULL THEN 'inserted'
                WHEN date_cleaned IS NOT NULL THEN 'cleaned' WHEN date_staged IS NOT NULL THEN 'staged'
                WHEN date_archived IS NOT NULL THEN 'archived' WHEN date_new IS NOT NULL THEN 'new' END"""


@registered(
    "ledger_stage",
    f"""SELECT source, "table", file_name, increment, stage,
               list_position(['new', 'archived', 'staged', 'cleaned', 'inserted', 'completed'], stage) AS stage_rank
        FROM (SELECT *, {_STAGE_SQL} AS stage FROM ({LEDGER_SQL}))""",
)
def ledger_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.with_stage(order_ledger(spark, sf_dir)).select(*book.ENTRY, "stage", "stage_rank")


@registered(
    "stage_order",
    f"""SELECT source, count(*) FILTER (r < 3) AS before_staged, count(*) FILTER (r <= 3) AS up_to_staged,
               count(*) FILTER (r > 3) AS after_staged, count(*) FILTER (r >= 3) AS from_staged,
               count(*) FILTER (r = 3) AS at_staged
        FROM (SELECT source, list_position(['new', 'archived', 'staged', 'cleaned', 'inserted', 'completed'], {_STAGE_SQL}) AS r
              FROM ({LEDGER_SQL})) GROUP BY 1""",
)
def stage_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked, staged = book.with_stage(order_ledger(spark, sf_dir)), stage_rank("staged")
    rank = F.col("stage_rank")
    return ranked.groupBy("source").agg(
        F.count_if(rank < staged).alias("before_staged"),
        F.count_if(rank <= staged).alias("up_to_staged"),
        F.count_if(rank > staged).alias("after_staged"),
        F.count_if(rank >= staged).alias("from_staged"),
        F.count_if(rank == staged).alias("at_staged"),
    )


@registered(
    "ledger_advance",
    f"""SELECT * REPLACE (
          CASE WHEN increment = 0 AND "table" <> 'orders_p' THEN coalesce(date_inserted, TIMESTAMP '{AT}') ELSE date_inserted END AS date_inserted,
          CASE WHEN increment = 0 AND "table" <> 'orders_p' AND date_inserted IS NULL THEN TIMESTAMP '{AT}' ELSE _date_row_updated END AS _date_row_updated)
        FROM ({LEDGER_SQL})""",
)
def ledger_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open and final orders come to "inserted"; those there already keep their stamps."""
    entries = order_files(spark, sf_dir).where("o_orderstatus <> 'P'").select(*book.FILE, F.lit(0).alias("increment"))
    return _view(book.advance(order_ledger(spark, sf_dir), entries, "inserted", _at()))


_COUNTS_SQL = f"""SELECT {_FILE_SQL}, 0 AS increment, CAST(count(*) AS INTEGER) AS rows_read
                  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL"""


def _line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per order file: counted by key first, then given their file's name."""
    counts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("rows_read"))
    files = order_files(spark, sf_dir)
    return files.join(counts, F.col("o_orderkey") == F.col("l_orderkey")).select(
        *book.FILE, F.lit(0).alias("increment"), "rows_read"
    )


@registered(
    "rows_read",
    f"""SELECT {_FILE_SQL}, 0 AS increment, CAST(count(*) AS INTEGER) AS rows_read
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""",
)
def rows_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = order_files(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    staged = lines.join(files, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("increment", F.lit(0))
    return book.count_rows(staged)


@registered(
    "ledger_rows_read",
    f"""SELECT l.* REPLACE (coalesce(x.rows_read, l.rows_read) AS rows_read,
                            CASE WHEN x.rows_read IS NOT NULL THEN TIMESTAMP '{AT}' ELSE l._date_row_updated END AS _date_row_updated)
        FROM ({LEDGER_SQL}) l LEFT JOIN ({_COUNTS_SQL}) x ON {_KEY_MATCH}""",
)
def ledger_rows_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(book.set_rows_read(order_ledger(spark, sf_dir), _line_counts(spark, sf_dir), _at(), unique=True))


@registered(
    "ledger_processed_name",
    f"""SELECT * REPLACE (CASE WHEN increment = 0 AND "table" = 'orders_o' THEN 'pre_' || file_name END AS processed_file_name,
                          CASE WHEN increment = 0 AND "table" = 'orders_o' THEN TIMESTAMP '{AT}' ELSE _date_row_updated END AS _date_row_updated)
        FROM ({LEDGER_SQL})""",
)
def ledger_processed_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = (
        order_files(spark, sf_dir)
        .where("o_orderstatus = 'O'")
        .select(*book.FILE, F.lit(0).alias("increment"), F.concat(F.lit("pre_"), "file_name").alias("processed_file_name"))
    )
    return _view(book.set_processed_name(order_ledger(spark, sf_dir), names, _at()))


@registered(
    "ledger_resume",
    f"SELECT * FROM ({LEDGER_SQL}) WHERE increment = 0 AND date_inserted IS NULL AND date_completed IS NULL",
)
def ledger_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files of a batch of all orders a restart still has to load."""
    files = order_files(spark, sf_dir).select(*book.FILE)
    return _view(book.unfinished(order_ledger(spark, sf_dir), files, "inserted"))


@registered(
    "ledger_review_entries",
    f"""SELECT source, "table", file_name, CAST(NULL AS VARCHAR) AS processed_file_name, 1 AS increment,
               TIMESTAMP '{AT}' AS date_new, TIMESTAMP '{AT}' AS date_archived, TIMESTAMP '{AT}' AS date_staged,
               CAST(NULL AS TIMESTAMP) AS date_cleaned, CAST(NULL AS TIMESTAMP) AS date_inserted,
               CAST(NULL AS TIMESTAMP) AS date_completed, rows_read,
               TIMESTAMP '{AT}' AS _date_row_inserted, CAST(NULL AS TIMESTAMP) AS _date_row_updated
        FROM ({_COUNTS_SQL})""",
)
def ledger_review_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = _line_counts(spark, sf_dir).withColumnRenamed("rows_read", "rows_failed")
    return _view(book.review_entries(failing, _at()))


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given up: first attempts of orders with low priority, second attempts of urgent ones."""
    files = order_files(spark, sf_dir)
    low = files.where("source = '5-LOW'").select(*book.FILE, F.lit(0).alias("increment"))
    return low.unionByName(files.where("source = '1-URGENT'").select(*book.FILE, F.lit(1).alias("increment")))


def _abandoned(spark: SparkSession, sf_dir: str) -> book.Abandoned:
    ledger = order_ledger(spark, sf_dir)
    staged = ledger.where("date_staged IS NOT NULL").select(*book.ENTRY)
    return book.abandon(ledger, staged, _claims(spark, sf_dir))


_CLAIMED = "((source = '5-LOW' AND increment = 0) OR (source = '1-URGENT' AND increment = 1))"


@registered(
    "abandon_ledger",
    f"""SELECT * FROM ({LEDGER_SQL}) WHERE NOT ({_CLAIMED} AND increment = 0 AND date_inserted IS NULL)""",
)
def abandon_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(_abandoned(spark, sf_dir).ledger)


@registered(
    "abandon_staged",
    f"""SELECT source, "table", file_name, increment FROM ({LEDGER_SQL})
        WHERE date_staged IS NOT NULL AND NOT ({_CLAIMED} AND date_inserted IS NULL)""",
)
def abandon_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _abandoned(spark, sf_dir).staged


@registered(
    "abandon_refused",
    f"""SELECT source, "table", file_name, increment, {_STAGE_SQL} AS stage FROM ({LEDGER_SQL})
        WHERE {_CLAIMED} AND date_inserted IS NOT NULL""",
)
def abandon_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _abandoned(spark, sf_dir).refused


@registered(
    "ledger_drop_entries",
    f"""SELECT * FROM ({LEDGER_SQL}) WHERE source <> '1-URGENT'""",
)
def ledger_drop_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files refused by pre-processing leave the ledger with all their attempts."""
    refused = order_files(spark, sf_dir).where("source = '1-URGENT'")
    return _view(book.drop_entries(order_ledger(spark, sf_dir), refused))


for _type, _condition in {
    "All": "TRUE",
    "Incomplete": "date_completed IS NULL",
    "Issues": "increment > 0 AND date_completed IS NULL",
    "Complete": "date_completed IS NOT NULL",
}.items():

    def _status(spark: SparkSession, sf_dir: str, entry_type: str = _type) -> DataFrame:
        return _view(book.status_view(order_ledger(spark, sf_dir), entry_type))

    registered(f"status_{_type.lower()}", f"SELECT * FROM ({LEDGER_SQL}) WHERE {_condition}")(_status)


@registered(
    "status_of_table",
    f"""SELECT * FROM ({LEDGER_SQL}) WHERE date_completed IS NULL AND source = '2-HIGH' AND "table" = 'orders_o'""",
)
def status_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(book.status_view(order_ledger(spark, sf_dir), "Incomplete", "2-HIGH", "orders_o"))


@registered("facets", f'SELECT DISTINCT "table" FROM ({LEDGER_SQL}) ORDER BY 1')
def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.facets(order_ledger(spark, sf_dir), "table")


@registered(
    "rename_ledger",
    f"""SELECT * REPLACE (CASE WHEN source = '3-MEDIUM' AND "table" = 'orders_f' THEN 'final_orders' ELSE "table" END AS "table")
        FROM ({LEDGER_SQL})""",
)
def rename_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(book.rename_table(order_ledger(spark, sf_dir), "3-MEDIUM", "orders_f", "final_orders").ledger)


@registered(
    "rekey_rows",
    """SELECT l.* EXCLUDE (l_orderkey), coalesce(m.new_hash, l.l_orderkey) AS _hash FROM lineitem l
       LEFT JOIN (SELECT o_orderkey, -o_orderkey - 1 AS new_hash FROM orders WHERE o_orderstatus = 'P') m
         ON l.l_orderkey = m.o_orderkey""",
)
def rekey_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = (
        table(spark, sf_dir, "orders")
        .where("o_orderstatus = 'P'")
        .select(F.col("o_orderkey").alias("hash"), (-F.col("o_orderkey") - 1).alias("new_hash"))
    )
    rows = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "_hash")
    return book.rekey_rows(rows, mapping)


@registered(
    "missing_files",
    """SELECT file_name FROM (SELECT 'order_' || o_orderkey || '.csv' AS file_name, o_orderkey FROM orders)
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order files that no line ever arrived for."""
    present = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("order_"), "l_orderkey", F.lit(".csv")).alias("file_name")
    )
    return missing_files(order_files(spark, sf_dir).select("file_name"), present)


def _murmur(previous: str, text: str, result: str) -> str:
    """One step of the 32-bit Murmur3 hash (the variant that takes tail bytes one by one), for ASCII text."""
    mask = "4294967295::UBIGINT"

    def rotated(x: str, by: int) -> str:
        return f"((({x}) << {by}) & {mask} | (({x}) >> {32 - by}))"

    def times(x: str, y: int) -> str:
        return f"((({x}) * {y}::UBIGINT) & {mask})"

    def mixed(seed: str, word: str) -> str:
        k = times(rotated(times(word, 0xCC9E2D51), 15), 0x1B873593)
        return f"(({times(rotated(f'xor({seed}, {k})', 13), 5)} + 3864292196::UBIGINT) & {mask})"

    def byte(at: str) -> str:
        return f"ord(substr({text}, {at}, 1))::UBIGINT"

    whole = f"(length({text}) // 4)"
    words = (
        f"list_transform(range(0, {whole}), lambda w: {byte('w * 4 + 1')} + {byte('w * 4 + 2')} * 256::UBIGINT"
        f" + {byte('w * 4 + 3')} * 65536::UBIGINT + {byte('w * 4 + 4')} * 16777216::UBIGINT)"
    )
    tail = f"list_transform(range({whole} * 4, length({text})), lambda b: {byte('b + 1')})"
    body = f"list_reduce(list_concat([{previous}::UBIGINT], {words}, {tail}), lambda h, k: {mixed('h', 'k')})"
    return f"""SELECT *, xor(g, g >> 16) AS {result} FROM (
        SELECT * EXCLUDE (f), {times('xor(f, f >> 13)', 0xC2B2AE35)} AS g FROM (
        SELECT * EXCLUDE (e), {times('xor(e, e >> 16)', 0x85EBCA6B)} AS f FROM (
        SELECT *, xor({body}, length({text})::UBIGINT) AS e FROM """


HASH_SQL = f"""
    WITH files AS (SELECT {_FILE_SQL} FROM orders),
         h1 AS ({_murmur("42", "source", "a")} files)))),
         h2 AS ({_murmur("a", '"table"', "b")} (SELECT * EXCLUDE (g) FROM h1))))),
         h3 AS ({_murmur("b", "file_name", "c")} (SELECT * EXCLUDE (g) FROM h2))))),
         hashed AS (SELECT source, "table", file_name,
                           CAST(CASE WHEN c >= 2147483648 THEN c::BIGINT - 4294967296 ELSE c::BIGINT END AS INTEGER) AS hash FROM h3)"""


@registered("file_hash", f"{HASH_SQL} SELECT * FROM hashed")
def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_files(spark, sf_dir).select(*book.FILE, file_hash(*book.FILE).alias("hash"))


@registered(
    "staged_identity",
    f"""{HASH_SQL}
    SELECT file_name, "table" || '_' || replace(CAST(hash AS VARCHAR), '-', 'm') AS staged,
           "table" || '_' || replace(CAST(hash AS VARCHAR), '-', 'm') || '_1' AS review,
           "table" || '_' || replace(CAST(hash AS VARCHAR), '-', 'm') || '_2' AS second_review
    FROM hashed""",
)
def staged_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = order_files(spark, sf_dir).withColumn("hash", file_hash(*book.FILE))
    return named.select(
        "file_name",
        staged_id("table", "hash").alias("staged"),
        review_id("table", "hash").alias("review"),
        review_id("table", "hash", 1).alias("second_review"),
    )


@registered(
    "rename_mapping",
    f"""{HASH_SQL},
         moved AS (SELECT 'final_orders' AS "table", source, file_name FROM files WHERE source = '3-MEDIUM' AND "table" = 'orders_f'),
         m1 AS ({_murmur("42", "source", "a")} moved)))),
         m2 AS ({_murmur("a", '"table"', "b")} (SELECT * EXCLUDE (g) FROM m1))))),
         m3 AS ({_murmur("b", "file_name", "c")} (SELECT * EXCLUDE (g) FROM m2)))))
    SELECT h.hash, CAST(CASE WHEN c >= 2147483648 THEN c::BIGINT - 4294967296 ELSE c::BIGINT END AS INTEGER) AS new_hash
    FROM hashed h JOIN m3 ON h.source = m3.source AND h.file_name = m3.file_name WHERE h."table" = 'orders_f'""",
)
def rename_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.rename_table(order_ledger(spark, sf_dir), "3-MEDIUM", "orders_f", "final_orders").mapping
