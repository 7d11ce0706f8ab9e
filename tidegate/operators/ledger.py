"""The import ledger: one row per file and attempt, one stamp per stage.

Entries are identified by (source, table, file_name, increment); the 32-bit hash is
carried as an attribute, since two files may share it.

The ledger is stored as events: what is learnt of some entries is appended, and `fold`
makes the ledger of the events. An event is one entry's new stamps, row count or processed
name, or says that the entry is gone. Functions whose names end with _events give what an
operation appends, which is as much as it has entries, however large the ledger is; the
others take a ledger frame and return its new state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.compare import filter_join, quoted
from tidegate.functions.marks import STAGES, current_stage, file_hash, reached, stage_rank, stamp, stamp_column
from tidegate.operators.dml import delete_matching, matching, new, update_from, update_where

# The ledger's columns.
SCHEMA = T.StructType(
    [
        T.StructField("hash", T.IntegerType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("table", T.StringType(), False),
        T.StructField("file_name", T.StringType(), False),
        T.StructField("processed_file_name", T.StringType()),
        T.StructField("increment", T.IntegerType(), False),
        *[T.StructField(stamp_column(s), T.TimestampType(), s != "new") for s in STAGES],
        T.StructField("rows_read", T.IntegerType()),
        T.StructField("_date_row_inserted", T.TimestampType(), False),
        T.StructField("_date_row_updated", T.TimestampType()),
    ]
)
FILE = ("source", "table", "file_name")
ENTRY = (*FILE, "increment")
_STAMPS = tuple(stamp_column(s) for s in STAGES)
# `_at` is when it was said, `_seq` the order in which events came, `_gone` ends an entry.
EVENTS = T.StructType(
    [
        *[T.StructField(f.name, f.dataType) for f in SCHEMA.fields if not f.name.startswith("_")],
        T.StructField("_at", T.TimestampType()),
        T.StructField("_seq", T.LongType()),
        T.StructField("_gone", T.BooleanType()),
    ]
)


class Registered(NamedTuple):
    ledger: DataFrame
    rejected: DataFrame


class Abandoned(NamedTuple):
    ledger: DataFrame
    staged: DataFrame
    refused: DataFrame


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def _attempt(files: DataFrame) -> Column:
    return quoted("increment").cast("int") if "increment" in files.columns else F.lit(0)


def entries_for(files: DataFrame, at: datetime | Column, extra_stages: Sequence[str] = ()) -> DataFrame:
    """New ledger rows, stamped for "new" and the extra stages.

    `files` holds source, table, file_name and, optionally, increment,
    processed_file_name and rows_read.
    """
    stamped = {"new", *extra_stages}
    for stage in stamped:
        stamp_column(stage)
    never = F.lit(None).cast("timestamp")

    def optional(name: str, kind: str) -> Column:
        return quoted(name).cast(kind) if name in files.columns else F.lit(None).cast(kind)

    return files.select(
        file_hash(*FILE).alias("hash"),
        *FILE,
        optional("processed_file_name", "string").alias("processed_file_name"),
        _attempt(files).alias("increment"),
        *[(stamp(at) if s in stamped else never).alias(stamp_column(s)) for s in STAGES],
        optional("rows_read", "int").alias("rows_read"),
        stamp(at).alias("_date_row_inserted"),
        never.alias("_date_row_updated"),
    )


def register(
    ledger: DataFrame, files: DataFrame, at: datetime | Column, extra_stages: Sequence[str] = ()
) -> Registered:
    """Add an entry for each file that has none; entries already there stay untouched.

    An attempt above 0 needs the attempt before it in the ledger; those lacking it are
    returned as rejected.
    """
    fresh, rejected = _unregistered(ledger, files)
    return Registered(ledger.unionByName(entries_for(fresh, at, extra_stages)), rejected)


def _unregistered(ledger: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files and attempts to add, those that lack the attempt before them)."""
    wanted = files.withColumn("increment", _attempt(files)).dropDuplicates(list(ENTRY))
    held = filter_join(ledger.select(*ENTRY), wanted.select(*FILE).distinct(), list(FILE), "left_semi")
    # Each ledger row says two things: its own attempt is there, and the next may follow.
    told = F.array(
        F.struct(F.col("increment"), F.lit(True).alias("held"), F.lit(False).alias("preceded")),
        F.struct((F.col("increment") + 1).alias("increment"), F.lit(False).alias("held"), F.lit(True).alias("preceded")),
    )
    known = (
        held.select(*FILE, F.explode(told).alias("t"))
        .groupBy(*FILE, F.col("t.increment").alias("increment"))
        .agg(F.bool_or("t.held").alias("__held"), F.bool_or("t.preceded").alias("__preceded"))
    )
    judged = wanted.join(known, list(ENTRY), "left")
    orphaned = (F.col("increment") > 0) & ~F.coalesce(F.col("__preceded"), F.lit(False))
    absent = ~F.coalesce(F.col("__held"), F.lit(False))
    rejected = judged.where(orphaned).select(*[quoted(c) for c in wanted.columns])
    return judged.where(absent & ~orphaned).drop("__held", "__preceded"), rejected


def _as_events(rows: DataFrame, at: Column, seq: int) -> DataFrame:
    """Rows that hold some of the ledger's columns as events."""
    held = {"_at": at, "_seq": F.lit(seq).cast("long"), "_gone": F.lit(False)}
    return rows.select(
        *[
            (held[f.name] if f.name in held else quoted(f.name) if f.name in rows.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in EVENTS.fields
        ]
    )


def fold(events: DataFrame) -> DataFrame:
    """The ledger that the events add up to, with one shuffle of them.

    A stage keeps its first stamp; row count and processed name are the last ones said.
    What was said of an entry before it went does not count.
    """
    entry = Window.partitionBy(*ENTRY)
    gone = F.max(F.when(F.col("_gone"), F.col("_seq"))).over(entry)
    live = events.withColumn("__gone", gone).where("NOT _gone AND (__gone IS NULL OR _seq > __gone)")
    starts = F.col("date_new").isNotNull()

    def last(name: str) -> Column:
        return F.max_by(quoted(name), F.when(quoted(name).isNotNull(), F.col("_seq"))).alias(name)

    folded = live.groupBy(*ENTRY).agg(
        F.first("hash", ignorenulls=True).alias("hash"),
        last("processed_file_name"),
        *[F.min(c).alias(c) for c in _STAMPS],
        last("rows_read"),
        F.min(F.when(starts, F.col("_at"))).alias("_date_row_inserted"),
        F.max(F.when(~starts, F.col("_at"))).alias("_date_row_updated"),
    )
    return folded.where("date_new IS NOT NULL").select(*SCHEMA.fieldNames())


def events_of(ledger: DataFrame, seq: int) -> DataFrame:
    """Events that add up to this ledger: one of an entry's beginning, one of what came after."""
    begun = ledger.select("hash", *ENTRY, "processed_file_name", *_STAMPS, "rows_read", "_date_row_inserted")
    changed = ledger.where(F.col("_date_row_updated").isNotNull()).select("hash", *ENTRY, "_date_row_updated")
    return _as_events(begun, F.col("_date_row_inserted"), seq).unionByName(
        _as_events(changed, F.col("_date_row_updated"), seq)
    )


def register_events(
    ledger: DataFrame, files: DataFrame, at: datetime | Column, seq: int, extra_stages: Sequence[str] = ()
) -> DataFrame:
    """What `register` adds; `ledger` needs to hold the entries of these files only."""
    fresh, _ = _unregistered(ledger, files)
    return _as_events(entries_for(fresh, at, extra_stages), stamp(at), seq)


def advance_events(
    ledger: DataFrame,
    entries: DataFrame,
    stages: str | Sequence[str],
    at: datetime | Column,
    seq: int,
    rows_read: bool = False,
) -> DataFrame:
    """What `advance` changes; entries that change nothing give no event."""
    columns = [stamp_column(s) for s in ([stages] if isinstance(stages, str) else stages)]
    given = ["rows_read"] if rows_read else []
    held = lookup(ledger, entries).select("hash", *ENTRY, *columns)
    todo = held.join(entries.select(*ENTRY, *given), list(ENTRY)) if rows_read else held
    moved = F.lit(True) if rows_read else reduce(or_, [F.col(c).isNull() for c in columns])
    fresh = [F.when(F.col(c).isNull(), stamp(at)).alias(c) for c in columns]
    return _as_events(todo.where(moved).select("hash", *ENTRY, *given, *fresh), stamp(at), seq)


def entry_events(ledger: DataFrame, entries: DataFrame, seq: int) -> DataFrame:
    """Ledger rows, such as `review_entries` makes, as events, but those that have an entry."""
    fresh = delete_matching(entries, ledger, list(ENTRY))
    return _as_events(fresh, F.col("_date_row_inserted"), seq)


def processed_name_events(ledger: DataFrame, names: DataFrame, at: datetime | Column, seq: int) -> DataFrame:
    """What `set_processed_name` records."""
    named = names.select(*ENTRY, "processed_file_name")
    held = lookup(ledger, names).select("hash", *ENTRY).join(named, list(ENTRY))
    return _as_events(held, stamp(at), seq)


def drop_events(ledger: DataFrame, files: DataFrame, at: datetime | Column, seq: int) -> DataFrame:
    """What `drop_entries` removes: all attempts of the files end."""
    held = matching(ledger, files, list(FILE)).select("hash", *ENTRY)
    return _as_events(held, stamp(at), seq).withColumn("_gone", F.lit(True))


def of_files(events: DataFrame, files: DataFrame) -> DataFrame:
    """The events of these files; the others are neither shuffled nor folded."""
    return filter_join(events, files.select(*FILE).distinct(), list(FILE), "left_semi")


def lookup(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Entries of the given files and attempts."""
    wanted = files.withColumn("increment", _attempt(files))
    return matching(ledger, wanted, list(ENTRY))


def missing_entries(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Files and attempts that have no entry."""
    wanted = files.withColumn("increment", _attempt(files))
    return delete_matching(wanted, ledger, list(ENTRY))


def advance(
    ledger: DataFrame, entries: DataFrame, stages: str | Sequence[str], at: datetime | Column, rows_read: bool = False
) -> DataFrame:
    """Stamp one or more stages on the given entries where they have no stamp yet.

    With `rows_read`, the entries (one row each then) also bring that count along.
    """
    columns = [stamp_column(s) for s in ([stages] if isinstance(stages, str) else stages)]
    todo = entries.select(*ENTRY, "rows_read") if rows_read else entries.select(*ENTRY).distinct()
    moved = reduce(or_, [F.col(c).isNull() for c in columns])
    changes = {c: F.coalesce(F.col(c), stamp(at)) for c in columns}
    if rows_read:
        changes["rows_read"] = new("rows_read")
        moved = F.lit(True)
    changes["_date_row_updated"] = F.when(moved, stamp(at)).otherwise(F.col("_date_row_updated"))
    return update_from(ledger, todo, list(ENTRY), changes, unique=not rows_read)


def set_rows_read(ledger: DataFrame, counts: DataFrame, at: datetime | Column, unique: bool = False) -> DataFrame:
    """Record row counts (columns of the entry key and rows_read); `unique` if each entry has one, as by `count_rows`."""
    return update_from(
        ledger,
        counts.select(*ENTRY, "rows_read"),
        list(ENTRY),
        {"rows_read": new("rows_read"), "_date_row_updated": stamp(at)},
        unique=unique,
    )


def count_rows(staged: DataFrame) -> DataFrame:
    """Rows per entry of a staged frame that carries the entry key."""
    return staged.groupBy(*ENTRY).agg(F.count(F.lit(1)).cast("int").alias("rows_read"))


def set_processed_name(ledger: DataFrame, names: DataFrame, at: datetime | Column) -> DataFrame:
    """Record the name a file got by pre-processing."""
    return update_from(
        ledger,
        names.select(*ENTRY, "processed_file_name"),
        list(ENTRY),
        {"processed_file_name": new("processed_file_name"), "_date_row_updated": stamp(at)},
    )


def with_stage(ledger: DataFrame) -> DataFrame:
    """The ledger with each entry's current stage and its rank."""
    return ledger.withColumns({"stage": current_stage(), "stage_rank": stage_rank(current_stage())})


def unfinished(ledger: DataFrame, files: DataFrame, stage: str) -> DataFrame:
    """Entries of these files that have not come to `stage`: where a restart resumes."""
    return lookup(ledger, files).where(~reached(stage))


def review_entries(failing: DataFrame, at: datetime | Column) -> DataFrame:
    """Entries for quarantined rows (entry key, rows_failed) at the next attempt.

    Archived and staged are stamped: the review rows are that attempt's staging.
    """
    return entries_for(
        failing.select(
            *FILE, (F.col("increment") + 1).alias("increment"), F.col("rows_failed").cast("int").alias("rows_read")
        ),
        at,
        ("archived", "staged"),
    )


def drop_entries(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Remove files from the ledger, all their attempts."""
    return delete_matching(ledger, files, list(FILE))


def abandon(
    ledger: DataFrame, staged: DataFrame, claims: DataFrame, staged_keys: Mapping[str, str] | None = None
) -> Abandoned:
    """Give up the claimed attempts.

    `staged_keys` maps entry columns to the staged frame's names for them, and may
    leave out those that are the same for all its rows.

    Attempts that reached "inserted" are refused. Staged rows of the others go. An
    attempt above 0 ends there; for attempt 0 the file's entries go, all attempts.
    """
    claimed = lookup(ledger, claims)
    refused = with_stage(claimed.where(reached("inserted"))).select(*ENTRY, "stage")
    accepted = claimed.where(~reached("inserted"))
    names = dict(staged_keys or {c: c for c in ENTRY})
    doomed = accepted.where(reached("staged")).select(*[quoted(c).alias(n) for c, n in names.items()])
    left = delete_matching(staged, doomed, list(names.values()))
    state = drop_entries(ledger, accepted.where(F.col("increment") == 0))
    return Abandoned(state, left, refused)


# Fixed values.
ENTRY_TYPES = ("All", "Incomplete", "Issues", "Complete")


def status_view(
    ledger: DataFrame, entry_type: str = "Incomplete", source: str | None = None, table: str | None = None
) -> DataFrame:
    """Ledger entries by state, sorted by source, table and file name."""
    open_still = F.col("date_completed").isNull()
    by_type = {
        "All": F.lit(True),
        "Incomplete": open_still,
        "Issues": (F.col("increment") > 0) & open_still,
        "Complete": ~open_still,
    }
    if entry_type not in by_type:
        raise ValueError(f"unknown entry type {entry_type!r}, expected one of {ENTRY_TYPES}")
    view = ledger.where(by_type[entry_type])
    if source is not None:
        view = view.where(F.col("source") == source)
    if table is not None:
        view = view.where(F.col("table") == table)
    return view.orderBy("source", "table", "file_name")


def facets(ledger: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, sorted: the choices a filter offers."""
    return ledger.select(quoted(column)).distinct().orderBy(quoted(column))


class Renamed(NamedTuple):
    ledger: DataFrame
    mapping: DataFrame


def rename_table(ledger: DataFrame, source: str, old: str, to: str) -> Renamed:
    """The ledger after a table got a new name, and the old hash to new hash mapping.

    Files that share a 32-bit hash cannot be told apart by the rows; they go on sharing one,
    the smallest of their new ones.
    """
    here = (F.col("source") == source) & (F.col("table") == old)
    fresh = file_hash(F.col("source"), F.lit(to), F.col("file_name"))
    mapping = ledger.where(here).groupBy("hash").agg(F.min(fresh).alias("new_hash"))
    moved = update_from(
        ledger.where(here), mapping, "hash", {"table": F.lit(to), "hash": new("new_hash")}, unique=True
    )
    state = ledger.where(~here | here.isNull()).unionByName(moved)
    return Renamed(state, mapping.where(F.col("hash") != F.col("new_hash")))


def rekey_rows(rows: DataFrame, mapping: DataFrame, column: str = "_hash") -> DataFrame:
    """Rows with their lineage hash moved along the mapping (hash, new_hash)."""
    return update_from(rows, mapping.withColumnRenamed("hash", column), [column], {column: new("new_hash")})
