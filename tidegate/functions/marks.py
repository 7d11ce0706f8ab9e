"""Row lineage and stage expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The stages of a file in order.
STAGES = ("new", "archived", "staged", "cleaned", "inserted", "completed")


def file_hash(source: Column | str, table: Column | str, file_name: Column | str) -> Column:
    """32-bit signed identity of a file within its source and table."""
    return F.hash(source, table, file_name)


def stamp_column(stage: str) -> str:
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}; stages are {STAGES}")
    return f"date_{stage}"


def stamp(at: datetime | Column) -> Column:
    """One load time per batch, as a literal: reruns of a task see the same value.

    A time without zone is read in the session's zone (UTC in this library's settings),
    whatever zone the driver's machine has.
    """
    return at if isinstance(at, Column) else F.lit(at.isoformat(sep=" ")).cast("timestamp")


def with_lineage(df: DataFrame, file_hash_col: Column, at: datetime | Column) -> DataFrame:
    """Add the two engine columns every source table carries."""
    return df.withColumns({"_hash": file_hash_col, "_datetime_added": stamp(at)})


def current_stage() -> Column:
    """Last stage that has a stamp, read from the ledger's stage columns."""
    return F.coalesce(*[F.when(F.col(stamp_column(s)).isNotNull(), F.lit(s)) for s in reversed(STAGES)])


def stage_rank(stage: Column | str) -> Column:
    """1-based position of a stage, so that stages compare and sort."""
    if isinstance(stage, str):
        stamp_column(stage)
        stage = F.lit(stage)
    ranked = F.array_position(F.array(*[F.lit(s) for s in STAGES]), stage)
    return F.when(ranked > 0, ranked).cast("int")


def reached(stage: str) -> Column:
    """Has this ledger row come to `stage` or beyond?"""
    return F.coalesce(stage_rank(current_stage()) >= STAGES.index(stage) + 1, F.lit(False))
