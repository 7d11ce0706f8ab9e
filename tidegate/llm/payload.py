"""A row's own columns held together in one, so that no name of theirs can clash with another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted


def as_row(docs: DataFrame) -> Column:
    """All columns as one struct named row."""
    return F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row")


def own_columns(docs: DataFrame) -> list[Column]:
    """The columns back from the struct named row, as they were in `docs`."""
    return [F.col("row").getField(c).alias(c) for c in docs.columns]
