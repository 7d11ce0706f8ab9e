"""Row-level update and delete as frame-to-frame functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import any_null, apart, filter_join, keys_equal, quoted
from tidegate.functions.names import key_list
from tidegate.operators.dedup import has_copies

_UP = "__up_"


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that meet the condition; all sides read the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            (F.when(hit, changes[c].cast(df.schema[c].dataType)).otherwise(quoted(c)) if c in changes else quoted(c)).alias(c)
            for c in df.columns
        ]
    )


def update_from(
    df: DataFrame,
    updates: DataFrame,
    keys: str | Sequence[str],
    changes: Mapping[str, Column] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Update rows whose key occurs in `updates`; a key that occurs there twice is an error.

    `changes` maps a column to an expression over the row and, as `new(name)`, over
    the matching update; by default every non-key column of `updates` is taken over.
    `unique` vouches that no key occurs twice; otherwise one job counts the keys first.
    """
    keys = key_list(keys)
    if changes is None:
        changes = {c: new(c) for c in updates.columns if c not in keys}
    if not unique and has_copies(updates, keys):
        raise ValueError(f"several updates share a key {list(keys)}")
    side = updates.where(~any_null(keys)).select(
        *[(apart(c) if c in keys else quoted(c)).alias(_UP + c) for c in updates.columns], F.lit(True).alias(_UP + "hit")
    )
    joined = df.join(side, keys_equal(keys, [_UP + k for k in keys]), "left")
    hit = quoted(_UP + "hit").isNotNull()
    return joined.select(
        *[
            (F.when(hit, changes[c].cast(df.schema[c].dataType)).otherwise(quoted(c)) if c in changes else quoted(c)).alias(c)
            for c in df.columns
        ]
    )


def new(name: str) -> Column:
    """A column of the matching update row, for `update_from`."""
    return quoted(_UP + name)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is true go; false and unknown stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def _key_set(doomed: DataFrame, keys: list[str]) -> DataFrame:
    return doomed.where(~any_null(keys)).select(*[quoted(k) for k in keys]).distinct()


def delete_matching(df: DataFrame, doomed: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Remove the rows whose key occurs in `doomed`. NULL keys never match."""
    keys = key_list(keys)
    return filter_join(df, _key_set(doomed, keys), keys, "left_anti")


def matching(df: DataFrame, doomed: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The rows `delete_matching` removes."""
    keys = key_list(keys)
    return filter_join(df, _key_set(doomed, keys), keys, "left_semi")
