"""One row per key, as an aggregate.

Partial results are merged before the shuffle, so a key holding a large share of
the rows does not gather in one task the way a window over that key would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import any_null, apart, keys_equal, quoted
from tidegate.functions.names import key_list

_ROW = "__row"
COPIES = "__copies"


def one_per_key(df: DataFrame, keys: Sequence[str], pick: str, order_by: Sequence[Column | str] = ()) -> DataFrame:
    """`pick` is "latest" or "first" by `order_by`, or "any"; adds the copy count.

    Give an order without ties to have a repeatable result.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[quoted(c).alias(str(i)) for i, c in enumerate(rest)]) if rest else F.struct(F.lit(1).alias("0"))
    if pick == "any":
        chosen = F.first(row)
    elif pick in ("latest", "first"):
        if not order_by:
            raise ValueError(f"{pick!r} needs order_by")
        rank = F.struct(*[quoted(o) if isinstance(o, str) else o for o in order_by])
        chosen = F.max_by(row, rank) if pick == "latest" else F.min_by(row, rank)
    else:
        raise ValueError(f"pick must be 'latest', 'first' or 'any', not {pick!r}")
    grouped = df.groupBy(*[quoted(k) for k in keys]).agg(chosen.alias(_ROW), F.count(F.lit(1)).alias(COPIES))
    return grouped.select(
        *[quoted(k) for k in keys],
        *[F.col(f"{_ROW}.`{i}`").alias(name) for i, name in enumerate(rest)],
        F.col(COPIES),
    )


def has_copies(incoming: DataFrame, keys: str | Sequence[str]) -> bool:
    """Do any two rows share a (non-NULL) key? One job over the key columns."""
    keys = key_list(keys)
    counted = incoming.where(~any_null(keys)).groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias(COPIES))
    return not counted.where(F.col(COPIES) > 1).isEmpty()


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Last writer wins: the row with the greatest `order_by` for each key."""
    return one_per_key(df, keys, "latest", order_by).drop(COPIES).select(*[quoted(c) for c in df.columns])


def from_one_file(df: DataFrame, keys: Sequence[str], file_order: Sequence[str], pick: str) -> DataFrame:
    """For keys that several files of a batch hold, the rows of the "latest" or "first" file.

    The outcome of loading the files one after the other. All rows of the chosen file
    stay, also several of one key; rows with a NULL key match nothing and all stay.
    """
    keys = list(keys)
    order = F.struct(*[quoted(o) for o in file_order])
    chosen = F.max(order) if pick == "latest" else F.min(order)
    keyed = df.where(~any_null(keys))
    winners = (
        keyed.groupBy(*[quoted(k) for k in keys])
        .agg(chosen.alias("__file"))
        .select(*[apart(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__file")
    )
    same = keys_equal(keys, [f"__k{i}" for i in range(len(keys))]) & order.eqNullSafe(F.col("__file"))
    return keyed.join(winners, same, "left_semi").unionByName(df.where(any_null(keys)))
