"""Header audit: the first line of every file against the contract.

Spark's own reader gives the lines, as text without taking them apart where that is UTF-8; only a
file's first split is looked at, and of that one line per file is kept before anything is shuffled. Taking the line apart and comparing
it with the contract are expressions in the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import TableContract
from tidegate.sources.files import literal_path

# Stands for the separator while lines are read whole; no text file has it.
_NO_SEPARATOR = "\u0001"
_LINE = T.StructType([T.StructField("line", T.StringType())])
# What a line without text consists of, as Spark's CSV reader sees it.
_BLANKS = "".join(map(chr, range(33)))


def _literal(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def fields(line: Column, separator: str, quote: str) -> Column:
    """The line's fields: quoted ones may hold the separator, and a doubled quote for one."""
    line = F.regexp_replace(line, r"^[\s\uFEFF]+|\s+$", "")
    if not quote or len(separator) > 1:
        return F.split(line, _literal(separator))
    q, s = _literal(quote), _literal(separator)
    # With the separator before every field, no field is matched as empty text between two others.
    pattern = f"{s}({q}(?:(?!{q}).|{q}{q})*{q}|(?:(?!{s}).)*)"
    found = F.regexp_extract_all(F.concat(F.lit(separator), line), F.lit(pattern), F.lit(1))

    def plain(field: Column) -> Column:
        quoted = (F.length(field) > 1) & field.startswith(quote) & field.endswith(quote)
        inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit(quote * 2), F.lit(quote))
        return F.when(quoted, inner).otherwise(field)

    return F.transform(found, plain)


def headers(files: DataFrame, contract: TableContract) -> DataFrame:
    """(path, header) for each listed file; a file without any line has an empty header.

    The header is the first line that is neither blank nor a comment. The names of the files
    come to the driver, where Spark's file index holds them in any case.
    """
    spark = files.sparkSession
    paths = [literal_path(r.path) for r in files.select("path").toLocalIterator()]
    nothing = F.array().cast("array<string>").alias("header")
    if not paths:
        return files.select("path", nothing)
    options = contract.reader_options
    lines = _lines(spark, paths, options).select(
        F.col("_metadata.file_path").alias("at"), F.col("_metadata.file_block_start").alias("start"), "line",
        F.monotonically_increasing_id().alias("no"),
    )
    first = (
        lines.where(F.col("start") == 0)
        .where(F.ltrim(F.col("line"), F.lit(_BLANKS)) != "")
        .groupBy("at")
        # The path out of the aggregate: what is made of it below cannot move down to every line.
        .agg(F.min(F.struct("no", "line", "at")).alias("first"))
        .select("first.at", "first.line")
    )
    found = fields(F.col("line"), contract.separator, str(options.get("quote", '"'))).alias("header")
    # The reader names files percent-encoded, the listing as they are.
    plain = F.url_decode(F.replace(F.col("at"), F.lit("+"), F.lit("%2B")))
    return (
        files.select("path")
        .join(first.select(plain.alias("at"), found), _place(F.col("path")) == _place(F.col("at")), "left")
        .select("path", F.coalesce("header", F.array().cast("array<string>")).alias("header"))
    )


def _lines(spark: SparkSession, paths: list[str], options: Mapping[str, object]) -> DataFrame:
    """The files' lines but comments, one column `line`."""
    kept = {k.lower(): v for k, v in options.items() if k.lower() in ("encoding", "charset", "comment", "linesep")}
    if str(kept.get("encoding", kept.get("charset", "utf-8"))).lower() not in ("utf-8", "utf8"):
        # Spark's text reader takes bytes as they are; the CSV reader decodes them.
        reader = spark.read.schema(_LINE).options(**kept, header="false", sep=_NO_SEPARATOR, quote="", maxCharsPerColumn="-1")
        return reader.csv(paths)
    reader = spark.read.schema(_LINE)
    if "linesep" in kept:
        reader = reader.option("lineSep", kept["linesep"])
    lines, comment = reader.text(paths), str(kept.get("comment", ""))
    return lines.where(~F.col("line").startswith(comment)) if comment.strip("\0") else lines


def _place(path: Column) -> Column:
    """A path without the slashes that one of Spark's two ways of writing it adds after the scheme."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def judge(with_header: DataFrame, contract: TableContract) -> DataFrame:
    """Add what is wrong with each header, and whether the file must be refused.

    Extra columns, absent key columns and names that differ only in case refuse a
    file; other absent columns are allowed and listed.
    """
    names = F.array(*[F.lit(n) for n in contract.raw_names])
    clean_keys = {k for k in contract.keys}
    key_names = [raw for raw, field in zip(contract.raw_names, contract.schema.fields) if field.name in clean_keys]
    keys = F.array(*[F.lit(k) for k in key_names]).cast("array<string>")
    lowered = F.transform("header", lambda h: F.lower(h))
    repeated = F.filter(
        F.array_distinct(lowered), lambda n: F.size(F.filter(lowered, lambda other: other == n)) > 1
    )
    return with_header.withColumns(
        {
            "extra": F.array_except("header", names),
            "absent": F.array_except(names, F.col("header")),
            "absent_keys": F.array_except(keys, F.col("header")),
            "repeated": repeated,
        }
    ).withColumn("refused", (F.size("extra") > 0) | (F.size("absent_keys") > 0) | (F.size("repeated") > 0))


def audit(files: DataFrame, contract: TableContract) -> DataFrame:
    """Listed files with their header and its verdict."""
    return judge(headers(files, contract), contract)


def violations(audited: DataFrame) -> DataFrame:
    """One row per refused file and reason."""
    reasons = F.array(
        F.struct(F.lit("extra columns").alias("reason"), F.col("extra").alias("names")),
        F.struct(F.lit("key columns absent").alias("reason"), F.col("absent_keys").alias("names")),
        F.struct(F.lit("repeated columns").alias("reason"), F.col("repeated").alias("names")),
    )
    return (
        audited.where("refused")
        .select("path", F.explode(reasons).alias("r"))
        .select("path", "r.reason", "r.names")
        .where(F.size("names") > 0)
    )
