"""Match and change predicates used by every row-level merge."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its literal name, also when the name holds dots or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def any_null(names: list[str]) -> Column:
    return reduce(or_, [quoted(n).isNull() for n in names])


def keys_equal(left: list[str], right: list[str]) -> Column:
    """Plain equality on each key pair: a NULL key never matches."""
    return reduce(and_, [quoted(a) == quoted(b) for a, b in zip(left, right)])


def apart(name: str) -> Column:
    """The column's own value, in a form that hides how its rows are partitioned.

    For the keys of an aggregate that a join takes as its right side. The join then
    cannot take over the aggregate's partitioning, and both sides come to it by a
    shuffle of its own: what AQE needs to split a key (or NULL) that holds very many
    rows on the left. Otherwise a hot key's rows would all meet in one task. The extra
    shuffle is of one row per key.
    """
    return F.greatest(quoted(name), quoted(name))


def filter_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows of `left` with ("left_semi") or without ("left_anti") their keys in `right`.

    `left` may hold hot keys; `right` should hold each key once.
    """
    renamed = [f"__side{i}" for i in range(len(keys))]
    side = right.select(*[apart(k).alias(n) for k, n in zip(keys, renamed)])
    return left.join(side, keys_equal(keys, renamed), how)


def data_columns(columns: list[str], keys: list[str]) -> list[str]:
    """Columns whose change matters: neither keys nor engine columns (leading _)."""
    held = {k.lower() for k in keys}
    return [c for c in columns if c.lower() not in held and not c.startswith("_")]


def differs(pairs: list[tuple[Column, Column]]) -> Column:
    """True if any pair differs, NULL counting as a value. No pairs: never."""
    if not pairs:
        return F.lit(False)
    return reduce(or_, [~a.eqNullSafe(b) for a, b in pairs])
