"""Measures that a plan is chosen by: sizes, and keys that many rows share."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.compare import quoted
from tidegate.session import cut_lineage

# A key that holds a larger part of the rows than this is hot; there are fewer than 1 / HOT of them.
HOT = 1 / 256
# Bytes a measured frame may take to be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


class Settled(NamedTuple):
    frame: DataFrame
    rows: int


def settle(df: DataFrame, bound: int = BROADCAST_BYTES) -> Settled:
    """Compute a narrow frame once, reliably, and measure it.

    The frame carries a broadcast hint only if its measured size is within the bound;
    beyond it, joins with it shuffle. One job computes, a second one measures the copy.
    """
    return measured(cut_lineage(df), bound)


def measured(kept: DataFrame, bound: int = BROADCAST_BYTES) -> Settled:
    """`settle` for a frame read from a written table."""
    df = kept
    texts = [quoted(f.name) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    width = F.lit(16 * len(df.columns))
    for text in texts:
        width = width + F.coalesce(F.octet_length(text), F.lit(0))
    rows, size = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return Settled(F.broadcast(kept) if size <= bound else kept, rows)


def outgrows_broadcast(df: DataFrame) -> bool:
    """Is the frame, by its rows and its columns' usual widths, more than Spark would broadcast? One count."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    digits = "".join(c for c in limit if c.isdigit())
    unit = {"k": 10, "m": 20, "g": 30}.get(limit.lower().rstrip("b")[-1], 0)
    bound = -1 if limit.startswith("-") else int(digits) << unit
    fixed = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.LongType: 8,
             T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}
    width = 8 + sum(fixed.get(type(f.dataType), 24) for f in df.schema.fields)
    return df.count() * width > bound


def key_mark(df: DataFrame, keys: list[str]) -> Column:
    """One value per key: the column itself, or the columns' texts with their lengths."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, (T.IntegerType, T.LongType, T.StringType)):
        return quoted(keys[0])
    texts = [quoted(k).cast("string") for k in keys]
    return F.concat(*[part for t in texts for part in (F.length(t).cast("string"), F.lit(":"), t)])


def heavy_hitters(df: DataFrame, mark: Column, share: float = HOT) -> list:
    """Values of `mark` that hold more than this share of the rows, by a frequent-items sketch.

    One pass; a sketch of bounded size per task. Values named do occur; counts are estimates.
    """
    tracked = max(1024, 1 << math.ceil(math.log2(8 / share)))
    held = df.select(mark.alias("m"))
    found = held.agg(
        F.expr(f"approx_top_k(m, {math.ceil(1 / share)}, {tracked})").alias("top"), F.count("m").alias("n")
    ).first()
    return [t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] > share * found["n"]]
