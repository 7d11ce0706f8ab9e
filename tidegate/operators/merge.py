"""Row-level merge: (target, incoming) -> the table's new state, as one DataFrame.

Plan of the update merges. The target is the streamed (left) side of a left join
with the incoming rows, one per key. A small batch is broadcast by its size and
the target is not shuffled at all; a large one is shuffled on both sides, and AQE
splits a hot key on the left. Incoming rows without a counterpart are found by
an anti join against those target keys that occur in the batch; the distinct on the
target keys is partially aggregated before any shuffle, and Spark moves the semi
join below it when the batch is small enough to broadcast.
A batch too large to broadcast that has one row per key is one full outer join instead,
with the keys that many rows of the target share spread over many tasks.

The incoming rows are read several times: pass a written table (staged rows), not a
costly computation. The target is read twice, once for its keys alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import any_null, apart, data_columns, differs, filter_join, keys_equal, quoted
from tidegate.functions.names import key_list
from tidegate.operators.dedup import COPIES, one_per_key
from tidegate.operators.sizing import heavy_hitters, key_mark

# Fixed values.
MERGE_STRATEGIES = ("merge_date_rows", "merge_update", "merge_insert")
ROW_INSERTED, ROW_UPDATED = "_date_row_inserted", "_date_row_updated"

_IN = "__in_"
_HIT = "__hit"
# Tasks that the rows of one hot key are spread over in a full outer join.
SPREAD = 64


def _same_name(columns: Sequence[str], wanted: str) -> str | None:
    return next((c for c in columns if c.lower() == wanted.lower()), None)


def _fit(target: DataFrame, incoming: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Incoming columns under the target's names and types; unknown ones are refused."""
    picked, unknown = [], []
    for name in incoming.columns:
        if name in extra:
            picked.append(quoted(name))
            continue
        held = _same_name(target.columns, name)
        if held is None:
            unknown.append(name)
            continue
        wanted = target.schema[held].dataType
        value = quoted(name)
        picked.append((value if incoming.schema[name].dataType == wanted else value.cast(wanted)).alias(held))
    if unknown:
        raise ValueError(f"incoming columns {unknown} are not in the table; evolve it first")
    return incoming.select(*picked)


def _refuse_copies(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Fail the job if any row meets the condition. A filter, so it is never pruned."""
    return df.where(F.when(condition, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


class _Batch(NamedTuple):
    """Incoming rows as a merge takes them, under the target's names."""

    keys: list[str]
    columns: list[str]
    offered: DataFrame  # rows with a whole key, those that may be inserted
    single: DataFrame | None  # one row per key, if that had to be settled
    loose: DataFrame  # rows with NULL in their key
    policy: str  # "none": no two offered rows share a key


def _batch(
    target: DataFrame,
    incoming: DataFrame,
    keys: str | Sequence[str],
    on_duplicate: str,
    order_by: Sequence[Column | str],
    unique: bool,
    present: str | None,
) -> _Batch:
    if on_duplicate not in ("all", "error", "latest", "first"):
        raise ValueError(f"unknown duplicate policy {on_duplicate!r}")
    keys = [_same_name(target.columns, k) or k for k in key_list(keys)]
    missing = [k for k in keys if _same_name(incoming.columns, k) is None or k not in target.columns]
    if missing or not keys:
        raise ValueError(f"key columns {missing or keys} must be in both the table and the incoming rows")

    order_names = [o for o in order_by if isinstance(o, str)]
    aside = [o for o in order_names if _same_name(target.columns, o) is None]
    extra = aside + ([present] if present else [])
    incoming = _fit(target, incoming, extra)
    columns = [c for c in target.columns if c in incoming.columns]

    keyed = incoming.where(~any_null(keys))
    loose = incoming.where(any_null(keys))
    if unique:
        return _Batch(keys, columns, keyed, keyed, loose, "none")
    if on_duplicate in ("latest", "first"):
        single = one_per_key(keyed, keys, on_duplicate, order_by)
    elif on_duplicate == "error":
        single = _refuse_copies(
            one_per_key(keyed, keys, "any"), F.col(COPIES) > 1, "several incoming rows share a key"
        )
    else:
        return _Batch(keys, columns, keyed, None, loose, on_duplicate)
    return _Batch(keys, columns, single.drop(COPIES), single, loose, on_duplicate)


def merge(
    target: DataFrame,
    incoming: DataFrame,
    keys: str | Sequence[str],
    strategy: str,
    *,
    on_duplicate: str = "all",
    order_by: Sequence[Column | str] = (),
    unique: bool = False,
    large: bool = False,
    present: str | None = None,
    change_column: str | None = None,
) -> DataFrame:
    """New state of `target` after merging `incoming` on `keys`.

    merge_insert adds rows whose key the target lacks. merge_update also replaces
    rows of which any data column differs. merge_date_rows does the same but keeps
    the row's inserted stamp on update and leaves the updated stamp empty on insert.

    `on_duplicate` says what several incoming rows of one key mean: "all" inserts
    each of them if the key is new and fails if it would update a row; "error" fails
    always; "latest" and "first" choose by `order_by`, whose columns must be part of
    the incoming frame and are dropped unless the target has them.

    `unique` vouches that no two incoming rows share a key (see `has_copies`), which
    spares grouping the batch, and lets both joins read it from one shuffle.

    `large` says that the batch is too large to broadcast (see `outgrows_broadcast`). An
    update merge whose batch has one row per key is then one full outer join; keys that hold
    a large share of the target's rows, found by a sketch, are spread over many tasks.

    `present` names an incoming array column listing the columns a row's file really
    had; the others then keep their value on update.

    `change_column` adds keep / unchanged / update / insert per row.
    """
    if strategy not in MERGE_STRATEGIES:
        raise ValueError(f"{strategy!r} is no merge strategy, expected one of {MERGE_STRATEGIES}")
    batch = _batch(target, incoming, keys, on_duplicate, order_by, unique, present)
    if large and strategy != "merge_insert" and batch.single is not None:
        result = _outer(target, batch, strategy, present)
        return result.withColumnRenamed(_HIT, change_column) if change_column else result.drop(_HIT)
    inserts = _inserts(target, batch, strategy)
    if strategy == "merge_insert":
        hits = _present_keys(target, batch.offered, batch.keys)
        kept = _label_hits(target, hits, batch.keys) if change_column else target
    else:
        kept = _updates(target, batch, strategy, present)
        if not change_column:
            kept = kept.drop(_HIT)
    if change_column:
        inserts = inserts.withColumn(_HIT, F.lit("insert"))
    result = kept.unionByName(inserts, allowMissingColumns=True)
    return result.withColumnRenamed(_HIT, change_column) if change_column else result


def new_rows(
    target: DataFrame,
    incoming: DataFrame,
    keys: str | Sequence[str],
    *,
    on_duplicate: str = "all",
    order_by: Sequence[Column | str] = (),
    unique: bool = False,
    present: str | None = None,
) -> DataFrame:
    """The rows that a merge_insert adds: those whose key the target lacks, and those with NULL in it.

    Of the target only the keys are read, and none of its rows are in the result, so the
    result can be appended. Options as in `merge`.
    """
    return _inserts(target, _batch(target, incoming, keys, on_duplicate, order_by, unique, present), "merge_insert")


def _prefixed(df: DataFrame, grouped_by: list[str]) -> DataFrame:
    return df.select(*[(apart(c) if c in grouped_by else quoted(c)).alias(_IN + c) for c in df.columns])


def _present_keys(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys found on both sides."""
    names = [quoted(k) for k in keys]
    held = target.where(~any_null(keys)).select(*names).distinct()
    return held.join(incoming.select(*names).distinct(), keys, "left_semi")


def _label_hits(target: DataFrame, hits: DataFrame, keys: list[str]) -> DataFrame:
    marked = _prefixed(hits, keys).withColumn(_IN + _HIT, F.lit(True))
    return target.join(marked, keys_equal(keys, [_IN + k for k in keys]), "left").select(
        *[quoted(c) for c in target.columns],
        F.when(quoted(_IN + _HIT), F.lit("unchanged")).otherwise(F.lit("keep")).alias(_HIT),
    )


def _inserts(target: DataFrame, batch: _Batch, strategy: str) -> DataFrame:
    keys, columns = batch.keys, batch.columns
    hits = _present_keys(target, batch.offered, keys)
    # Under the same names as in `_updates`, so that one shuffle can serve both joins.
    side = _prefixed(batch.offered, [])
    fresh = filter_join(side, _prefixed(hits, []), [_IN + k for k in keys], "left_anti")
    fresh = fresh.select(*[quoted(_IN + c).alias(c) for c in columns])
    return _as_inserted(target, fresh.unionByName(batch.loose.select(*[quoted(c) for c in columns])), columns, strategy)


def _as_inserted(target: DataFrame, rows: DataFrame, columns: list[str], strategy: str) -> DataFrame:
    left_out = [ROW_UPDATED] if strategy == "merge_date_rows" else []
    return rows.select(
        *[
            (quoted(c) if c in columns and c not in left_out else F.lit(None).cast(target.schema[c].dataType)).alias(c)
            for c in target.columns
        ]
    )


def _offered(batch: _Batch, present: str | None, name: str) -> Column:
    """The matching incoming row's value; the row's own where its file had no such column."""
    value = quoted(_IN + name)
    if present and name in data_columns(batch.columns, batch.keys):
        return F.when(F.array_contains(quoted(_IN + present), name), value).otherwise(quoted(name))
    return value


def _changed(batch: _Batch, present: str | None) -> Column:
    return differs([(quoted(c), _offered(batch, present, c)) for c in data_columns(batch.columns, batch.keys)])


def _updated(target: DataFrame, batch: _Batch, strategy: str, present: str | None) -> dict[str, Column]:
    """The target's columns after the merge, by the column __changed."""
    frozen = {ROW_INSERTED} if strategy == "merge_date_rows" else set()
    return {
        c: F.when(F.col("__changed"), _offered(batch, present, c)).otherwise(quoted(c))
        if c in batch.columns and c not in batch.keys and c not in frozen
        else quoted(c)
        for c in target.columns
    }


def _updates(target: DataFrame, batch: _Batch, strategy: str, present: str | None) -> DataFrame:
    keys = batch.keys
    single = batch.single if batch.single is not None else one_per_key(batch.offered, keys, "any")
    side = _prefixed(single, [] if batch.policy == "none" else keys)
    joined = target.join(side, keys_equal(keys, [_IN + k for k in keys]), "left")
    matched = quoted(_IN + keys[0]).isNotNull()
    if batch.policy == "all":
        joined = _refuse_copies(
            joined, F.coalesce(quoted(_IN + COPIES), F.lit(1)) > 1, "several incoming rows match one table row"
        )
    return joined.withColumn("__changed", matched & _changed(batch, present)).select(
        *[value.alias(c) for c, value in _updated(target, batch, strategy, present).items()],
        F.when(~matched, F.lit("keep"))
        .when(F.col("__changed"), F.lit("update"))
        .otherwise(F.lit("unchanged"))
        .alias(_HIT),
    )


def _outer(target: DataFrame, batch: _Batch, strategy: str, present: str | None) -> DataFrame:
    """An update merge as one full outer join, with the change per row.

    The join cannot split a key, so the target's rows of a hot key get one of SPREAD numbers,
    and the batch's row of that key is there for each. A hot key is known from rows of the
    target, so its batch row has a counterpart and none of its copies is an insert. Rows of
    the target with NULL in their key match nothing; they are numbered too.
    """
    keys = batch.keys
    keyed = target.where(~any_null(keys))
    hot = heavy_hitters(keyed, key_mark(keyed, keys))
    number = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int")
    in_target = F.when(any_null(keys), number)
    in_batch = F.array(F.lit(0))
    if hot:
        in_target = in_target.when(key_mark(keyed, keys).isin(hot), number)
        in_batch = F.when(key_mark(keyed, keys).isin(hot), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(in_batch)
    left = target.select("*", in_target.otherwise(0).alias("__part"), F.lit(True).alias("__held"))
    copies = batch.single.drop(COPIES).select("*", F.size(in_batch).alias("__copies"), F.explode(in_batch).alias("__part"))
    side = copies.select(*[quoted(c).alias(_IN + c) for c in copies.columns])
    joined = left.join(side, keys_equal([*keys, "__part"], [_IN + k for k in [*keys, "__part"]]), "full_outer")
    held, matched = F.col("__held").isNotNull(), quoted(_IN + keys[0]).isNotNull()
    joined = joined.where(held | (quoted(_IN + "__copies") == 1))
    joined = joined.withColumn("__changed", held & matched & _changed(batch, present))
    left_out = {ROW_UPDATED} if strategy == "merge_date_rows" else set()
    kept = _updated(target, batch, strategy, present)

    def inserted(c: str) -> Column:
        return quoted(_IN + c) if c in batch.columns and c not in left_out else F.lit(None).cast(target.schema[c].dataType)

    result = joined.select(
        *[F.when(held, kept[c]).otherwise(inserted(c)).alias(c) for c in target.columns],
        F.when(~held, F.lit("insert"))
        .when(~matched, F.lit("keep"))
        .when(F.col("__changed"), F.lit("update"))
        .otherwise(F.lit("unchanged"))
        .alias(_HIT),
    )
    loose = _as_inserted(target, batch.loose.select(*[quoted(c) for c in batch.columns]), batch.columns, strategy)
    return result.unionByName(loose.withColumn(_HIT, F.lit("insert")))


def load(
    target: DataFrame,
    incoming: DataFrame,
    strategy: str,
    keys: str | Sequence[str] = (),
    **options,
) -> DataFrame:
    """New table state for any strategy. No incoming rows leave the table as it is."""
    if strategy.startswith("merge"):
        return merge(target, incoming, keys, strategy, **options)
    if strategy == "insert":
        return target.unionByName(_fit(target, incoming, ()), allowMissingColumns=True)
    if strategy == "replace":
        if incoming.isEmpty():
            return target
        none_kept = target.limit(0)
        return none_kept.unionByName(_fit(target, incoming, ()), allowMissingColumns=True)
    raise ValueError(f"unknown strategy {strategy!r}")
