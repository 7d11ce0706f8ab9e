"""Type-2 history of a table, after the "check" way of finding changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import any_null, apart, data_columns, differs, keys_equal, quoted
from tidegate.functions.marks import stamp
from tidegate.functions.names import key_list
from tidegate.operators.dedup import COPIES, one_per_key

VALID_FROM, VALID_TO = "_valid_from", "_valid_to"
_IN = "__in_"


def begin(current: DataFrame, at: datetime | Column) -> DataFrame:
    """A first history: every row open since `at`."""
    return current.withColumns({VALID_FROM: stamp(at), VALID_TO: F.lit(None).cast("timestamp")})


def snapshot(history: DataFrame, current: DataFrame, keys: str | Sequence[str], at: datetime | Column) -> DataFrame:
    """History after seeing `current` at `at`.

    Closed rows pass through without a join. An open row whose data changed is closed
    and followed by a new version, both made from one joined row. Keys not seen before
    are added; keys gone from `current` stay open. Several current rows of one key, or
    a NULL key, fail the job.
    """
    keys = key_list(keys)
    columns = current.columns
    now = stamp(at)
    single = one_per_key(current, keys, "any")
    single = single.where(
        F.when(
            (F.col(COPIES) > 1) | any_null(keys), F.raise_error(F.lit("snapshot keys must be unique and not NULL")).cast("boolean")
        ).otherwise(F.lit(True))
    ).drop(COPIES)

    closed = history.where(F.col(VALID_TO).isNotNull())
    opened = history.where(F.col(VALID_TO).isNull())
    side = single.select(
        *[(apart(c) if c in keys else quoted(c)).alias(_IN + c) for c in columns], F.lit(True).alias(_IN + "hit")
    )
    joined = opened.join(side, keys_equal(keys, [_IN + k for k in keys]), "left")
    changed = quoted(_IN + "hit").isNotNull() & differs(
        [(quoted(c), quoted(_IN + c)) for c in data_columns(columns, keys)]
    )

    def version(pick, start: Column, end: Column) -> Column:
        return F.struct(*[pick(c).alias(c) for c in columns], start.alias(VALID_FROM), end.alias(VALID_TO))

    never = F.lit(None).cast("timestamp")
    before = version(quoted, F.col(VALID_FROM), F.when(changed, now).otherwise(never))
    after = version(lambda c: quoted(_IN + c).cast(history.schema[c].dataType), now, never)
    versions = F.when(changed, F.array(before, after)).otherwise(F.array(before))
    moved = joined.select(F.explode(versions).alias("v")).select("v.*")

    seen = history.where(F.col(VALID_TO).isNull()).select(*[quoted(k) for k in keys]).distinct()
    known = seen.join(single.select(*[quoted(k) for k in keys]), keys, "left_semi")
    fresh = begin(single.join(known, keys, "left_anti").select(*[quoted(c) for c in columns]), at)
    return closed.unionByName(moved).unionByName(fresh)
