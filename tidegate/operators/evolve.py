"""Additive schema evolution: what a table lacks, and frames brought to a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.compare import quoted


def drift(have: T.StructType, want: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, issue, type in the table, type wanted); names compare without case.

    Issues: "missing" from the table, "type" differs, "extra" in the table. Engine
    columns (leading _) are not judged.
    """
    held = {f.name.lower(): f for f in have.fields}
    asked = {f.name.lower(): f for f in want.fields}
    found = []
    for name, field in asked.items():
        if name not in held:
            found.append((field.name, "missing", None, field.dataType.simpleString()))
        elif held[name].dataType != field.dataType:
            found.append((field.name, "type", held[name].dataType.simpleString(), field.dataType.simpleString()))
    for name, field in held.items():
        if name not in asked and not name.startswith("_"):
            found.append((field.name, "extra", field.dataType.simpleString(), None))
    return found


def drift_report(df: DataFrame, want: T.StructType) -> DataFrame:
    """Drift of a table against a schema, with the rows a change would touch."""
    found = drift(df.schema, want)
    rows = F.array(
        *[
            F.struct(
                F.lit(column).alias("column"),
                F.lit(issue).alias("issue"),
                F.lit(have).cast("string").alias("table_type"),
                F.lit(asked).cast("string").alias("wanted_type"),
            )
            for column, issue, have, asked in found
        ]
    ).cast("array<struct<column:string,issue:string,table_type:string,wanted_type:string>>")
    counted = df.agg(F.count(F.lit(1)).alias("table_rows"))
    return counted.select(F.explode(rows).alias("d"), "table_rows").select("d.*", "table_rows")


def add_columns(df: DataFrame, want: T.StructType) -> DataFrame:
    """The table with the columns it lacks, as NULLs; nothing else changes."""
    held = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in want.fields if f.name.lower() not in held])


def align(df: DataFrame, want: T.StructType) -> DataFrame:
    """Exactly the wanted columns in order: missing ones NULL, other types cast."""
    held = {c.lower(): c for c in df.columns}
    picked = []
    for field in want.fields:
        name = held.get(field.name.lower())
        if name is None:
            value = F.lit(None).cast(field.dataType)
        elif df.schema[name].dataType == field.dataType:
            value = quoted(name)
        else:
            value = quoted(name).try_cast(field.dataType)
        picked.append(value.alias(field.name))
    return df.select(*picked)
