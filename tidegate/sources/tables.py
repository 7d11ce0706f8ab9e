"""Tables as external parquet tables of Spark's catalog, each at a fixed path.

All reading and writing is Spark's: `insertInto`, with static overwrite for whole tables
and dynamic partition overwrite for parts. A table that rows are added to has the name of
the load as its last partition column, so a load repeated after a failure overwrites its
own rows and no others. A session whose catalog does not know a table opens it by its path.

Plain parquet has no transactions: while an overwrite runs, readers may see its partitions
without rows. What is written in place of a table's rows is complete elsewhere before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.compare import quoted
from tidegate.session import remove_folder, step_copy

# Partition column that names a row's load, in tables that rows are added to.
LOAD = "_load"
_MODE = "spark.sql.sources.partitionOverwriteMode"


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listing(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below this path, none if there is no such path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def has_data(spark: SparkSession, path: str) -> bool:
    """Are there data files or partition folders below this path?"""
    return any("=" in n or not n.startswith(("_", ".")) for n in folders(spark, path))


def create(spark: SparkSession, name: str, schema: T.StructType, root: str, partition_by: Sequence[str] = ()) -> None:
    """Open the table at this path, with all columns its files have, or create it there, empty.

    Of a table that the catalog has already, the columns it lacks are added.
    """
    if exists(spark, name):
        held = {c.name.lower() for c in spark.catalog.listColumns(name)}
        lacking = [f for f in schema.fields if f.name.lower() not in held]
        if lacking:
            evolve(spark, name, lacking)
        return
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    known = {f.name.lower() for f in schema.fields}
    held, found = has_data(spark, root), []
    if held:
        files = spark.read.option("mergeSchema", "true").parquet(root)
        found = [f for f in files.schema.fields if f.name.lower() not in known and f.name not in partition_by]
    columns = [*schema.fields, *found, *([T.StructField(LOAD, T.StringType())] if LOAD in partition_by else [])]
    parts = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {_quoted(name)} ({_listing(columns)}) USING parquet {parts} LOCATION {_literal(root)}")
    if partition_by and held:
        spark.catalog.recoverPartitions(name)


def read(spark: SparkSession, name: str) -> DataFrame:
    """The table's rows, without the name of their load."""
    return spark.table(name).drop(LOAD)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def evolve(spark: SparkSession, name: str, added: Sequence[T.StructField]) -> None:
    """Add nullable columns; rows already there read NULL."""
    spark.sql(f"ALTER TABLE {_quoted(name)} ADD COLUMNS ({_listing(added)})")


def _refuse_empty(state: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Spark's writer stores an empty string like NULL; fail instead of changing the value."""
    for p in partition_by:
        if isinstance(state.schema[p].dataType, T.StringType):
            message = F.lit(f"partition column {p!r} holds an empty string, which files cannot tell from NULL")
            state = state.where(F.when(quoted(p) == "", F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return state


@contextmanager
def _overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """The session's overwrite mode while one statement runs; insertInto knows no option for it."""
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


def _insert(spark: SparkSession, name: str, rows: DataFrame, load: str | None, mode: str | None) -> None:
    by = partition_columns(spark, name)
    if LOAD in by:
        rows = rows.withColumn(LOAD, F.lit(load or "all"))
    rows = rows.select(*[quoted(c.name) for c in spark.catalog.listColumns(name)])
    values = [p for p in by if p != LOAD]
    if values:
        # A rebalance, not a repartition: AQE splits a partition value that holds many rows.
        rows = _refuse_empty(rows, values).hint("rebalance", *values)
    with _overwriting(spark, mode or "static"):
        rows.write.insertInto(name, overwrite=mode is not None)
    spark.catalog.refreshTable(name)


def publish(
    spark: SparkSession, name: str, state: DataFrame, root: str, partition_by: Sequence[str] = (), load: str | None = None
) -> None:
    """Make `state` the table's whole content; it may be computed from the table.

    A table that exists keeps its partitioning; columns it lacks are added, partitions without rows in
    `state` go.
    """
    with step_copy(state) as complete:
        publish_complete(spark, name, complete, root, partition_by, load)


def publish_complete(
    spark: SparkSession, name: str, state: DataFrame, root: str, partition_by: Sequence[str] = (), load: str | None = None
) -> None:
    """`publish` for a state that has been written elsewhere already, and can be so again."""
    create(spark, name, state.schema, root, partition_by)
    held = {f.name for f in state.schema.fields}
    missing = [f for f in spark.table(name).schema.fields if f.name not in held and f.name != LOAD]
    state = state.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    _insert(spark, name, state, load, "static")


def replace_partitions(spark: SparkSession, name: str, complete: DataFrame) -> None:
    """Replace the partitions that occur in these rows, which have been written elsewhere; others stay untouched."""
    _insert(spark, name, complete, None, "dynamic")


def append(spark: SparkSession, name: str, rows: DataFrame, load: str | None = None) -> None:
    """Add rows, columns by name; nothing already there is read or rewritten.

    In a table partitioned by load, a repeat of a load overwrites what its first try has
    written. The rows must not depend on that: see `others`.
    """
    loads = LOAD in partition_columns(spark, name)
    if load is None or not loads:
        _insert(spark, name, rows, load, None)
    else:
        _insert(spark, name, rows, load, "dynamic")


def others(spark: SparkSession, name: str, load: str) -> DataFrame:
    """The table's rows but those that an earlier try of this load has left."""
    table = spark.table(name)
    return table.where(F.col(LOAD) != load).drop(LOAD) if LOAD in table.columns else table


def clear(spark: SparkSession, name: str) -> None:
    """Empty the table; its columns and its partitioning stay."""
    _insert(spark, name, spark.createDataFrame([], read(spark, name).schema), None, "static")


def drop(spark: SparkSession, name: str, root: str | None = None) -> None:
    """Drop the table from the catalog; with its root given, its files go too."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    if root is not None:
        remove_folder(spark, root)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Did a write to this folder finish?"""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)
