"""Contract-driven scans of delimited and JSON files, and staging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import ContractError, TableContract
from tidegate.functions.compare import filter_join, quoted
from tidegate.functions.marks import file_hash
from tidegate.functions.names import clean_label
from tidegate.operators.evolve import align
from tidegate.session import cut_lineage
from tidegate.sources.files import list_files, literal_path
from tidegate.sources.headers import audit, violations

FILE_NAME, FILE_TIME, FOLDER, INCREMENT, PRESENT, HASH = "_file_name", "_file_time", "_folder", "_increment", "_present", "_hash"
# The raw record of a row of which something could not be read; NULL otherwise.
RECORD = "_record"
_ORIGIN = (
    T.StructField(RECORD, T.StringType()),
    T.StructField(FILE_NAME, T.StringType()),
    T.StructField(FILE_TIME, T.TimestampType()),
    T.StructField(FOLDER, T.StringType()),
)


def _plain_file_name() -> Column:
    """The file's name as listed: `_metadata` has it percent-encoded, plus signs as they are.

    Evaluated for every row, so names without an encoded character are taken as they are.
    """
    name = F.col("_metadata.file_name")
    return F.when(name.contains("%"), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def _folder() -> Column:
    """The file's path up to its last slash, found from the end: a pattern would try every slash of every row."""
    path = F.col("_metadata.file_path")
    return F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1)


def _finish(raw: DataFrame, contract: TableContract, names: Sequence[str]) -> DataFrame:
    """Clean names, every contract column in order, and where each row came from."""
    renamed = raw.select(
        *[quoted(n).alias(clean_label(n)) for n in names],
        RECORD,
        _plain_file_name().alias(FILE_NAME),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
        _folder().alias(FOLDER),
    )
    origin = T.StructType([*contract.schema.fields, *_ORIGIN])
    present = F.array(*[F.lit(clean_label(n)) for n in names])
    return align(renamed, origin).withColumn(PRESENT, present)


def scan(
    spark: SparkSession, paths: str | Sequence[str], contract: TableContract, header: Sequence[str] | None = None
) -> DataFrame:
    """Typed rows of files that share one layout.

    `header` is that layout, in file order; by default the contract's. Fields that do
    not parse are NULL and the row stays. Spark checks each file's header against the
    schema while it scans (enforceSchema off), so a file of another layout fails the
    job instead of shifting columns.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if contract.format == "json":
        whole = T.StructType([*contract.read_schema.fields, _ORIGIN[0]])
        raw = spark.read.schema(whole).options(**contract.reader_options, columnNameOfCorruptRecord=RECORD).json(paths)
        return _finish(raw, contract, contract.raw_names)
    by_name = {f.name: f for f in contract.read_schema.fields}
    names = list(header) if header is not None else contract.raw_names
    schema = T.StructType([*[by_name[n] for n in names], _ORIGIN[0]])
    options = {"mode": "PERMISSIVE", **contract.reader_options, "enforceSchema": "false", "columnNameOfCorruptRecord": RECORD}
    raw = spark.read.schema(schema).options(**options).csv(paths)
    return _finish(raw, contract, names)


def scan_audited(spark: SparkSession, audited: DataFrame, contract: TableContract) -> DataFrame:
    """Typed rows of the accepted files of an audit: one scan per distinct header.

    The accepted paths come to the driver, as Spark's file index needs them there in
    any case; no data does.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for row in audited.where(~F.col("refused")).select("path", "header").toLocalIterator():
        layouts.setdefault(tuple(row.header), []).append(literal_path(row.path))
    result = spark.createDataFrame(
        [], T.StructType([*contract.schema.fields, *_ORIGIN, T.StructField(PRESENT, T.ArrayType(T.StringType()))])
    )
    for i, (header, paths) in enumerate(layouts.items()):
        rows = scan(spark, paths, contract, header)
        result = rows if i == 0 else result.unionByName(rows)
    return result


def raise_refused(refused: DataFrame) -> None:
    """Fail if there is any violation, naming some."""
    some = refused.limit(20).collect()
    if some:
        listed = "; ".join(f"{r.path}: {r.reason} {list(r.names)}" for r in some)
        count = refused.count()
        rest = f", and {count - len(some)} more" if count > len(some) else ""
        raise ContractError(f"files do not fit the contract: {listed}{rest}")


def read_files(
    spark: SparkSession, paths: str | Sequence[str], contract: TableContract, on_refused: str = "raise"
) -> tuple[DataFrame, DataFrame | None]:
    """(typed rows, refused files) of a batch of files with possibly different headers.

    `on_refused` is "raise" or "skip". JSON files and files without header have no
    audit: their refused frame is None.
    """
    if not contract.has_header:
        return scan(spark, paths, contract), None
    audited = cut_lineage(audit(list_files(spark, paths), contract))
    refused = violations(audited)
    if on_refused == "raise":
        raise_refused(refused)
    return scan_audited(spark, audited, contract), refused


def staged_rows(rows: DataFrame, contract: TableContract, increment: int = 0) -> DataFrame:
    """Scanned rows as staged rows: pre-processed, with file hash and attempt."""
    if contract.preprocess is not None:
        rows = contract.preprocess(rows)
    return rows.withColumns(
        {
            INCREMENT: F.lit(increment),
            HASH: file_hash(F.lit(contract.source), F.lit(contract.table), F.col(FILE_NAME)),
        }
    )


def stage_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    contract: TableContract,
    increment: int = 0,
    on_refused: str = "raise",
) -> DataFrame:
    """Files to staged rows in one call; pure, so a retry gives the same rows."""
    rows, _ = read_files(spark, paths, contract, on_refused)
    return staged_rows(rows, contract, increment)


def proceeding(staged: DataFrame, contract: TableContract) -> tuple[DataFrame, DataFrame | None]:
    """(rows of files that may go on, files that may not) by the contract's condition.

    The condition is an aggregate over each file's rows.
    """
    if contract.proceed is None:
        return staged, None
    judged = staged.groupBy(FILE_NAME).agg(F.coalesce(contract.proceed, F.lit(False)).alias("__go"))
    stopped = judged.where(~F.col("__go")).select(FILE_NAME)
    return filter_join(staged, stopped, [FILE_NAME], "left_anti"), stopped
