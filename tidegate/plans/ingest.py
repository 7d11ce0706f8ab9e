"""A batch of files through all stages, and quarantined rows back into them.

    list -> register -> header audit -> stage -> mark -> quarantine / load -> complete

Each step is one plan over the whole batch. Step results that later steps read more
than once (staged rows, marked rows, a table's next state) are written below the store's
shared root, so a lost executor repeats a step at most, and a restart of the same batch
goes on from the last step that finished. The ledger is appended to, a few events per file
and step; only the events of the batch's own files are folded to see where they are.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import TableContract
from tidegate.functions.compare import filter_join, quoted
from tidegate.functions.marks import stamp
from tidegate.operators import ledger as book
from tidegate.operators import quality
from tidegate.operators.dedup import from_one_file, has_copies
from tidegate.operators.evolve import align
from tidegate.operators.merge import load, new_rows
from tidegate.operators.sizing import outgrows_broadcast
from tidegate.session import cut_lineage, remove_folder, setting, step_copy
from tidegate.sources import tables
from tidegate.sources.files import list_files, literal_path
from tidegate.sources.headers import audit, violations
from tidegate.sources.scan import (
    FILE_NAME,
    FILE_TIME,
    FOLDER,
    HASH,
    INCREMENT,
    PRESENT,
    RECORD,
    proceeding,
    raise_refused,
    scan,
    scan_audited,
    staged_rows,
)

CLEAN = "__clean"
# Strategies that add rows to a table and leave those there as they are.
ADDING = ("insert", "merge_insert", "replace")

# The files of a staged batch.
LISTED = "source string, table string, file_name string, path string, run string"


@dataclass(frozen=True)
class Store:
    """Where tables, the ledger and step results live: a folder all executors reach."""

    spark: SparkSession
    root: str
    ledger_name: str = "orchestration.import_file"

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def events(self) -> DataFrame:
        """What the ledger is made of, partitioned by source and table."""
        tables.create(self.spark, self.ledger_name, book.EVENTS, self.path("ledger"), ("source", "table"))
        return tables.read(self.spark, self.ledger_name)

    def ledger(self, contract: TableContract | None = None) -> DataFrame:
        """The ledger, or the part of one table, which is all that is read then."""
        events = self.events()
        if contract is not None:
            events = events.where((F.col("source") == contract.source) & (F.col("table") == contract.table))
        return book.fold(events)

    def entries(self, contract: TableContract, files: DataFrame) -> DataFrame:
        """The ledger's entries of these files of one table."""
        events = self.events().where((F.col("source") == contract.source) & (F.col("table") == contract.table))
        return book.fold(book.of_files(events, files))

    def sequence(self) -> int:
        """The place of what is recorded next; later calls give larger numbers."""
        return time.time_ns()

    def record(self, events: DataFrame) -> None:
        """Append events to the ledger. A repeat of the same events changes nothing."""
        self.events()
        tables.append(self.spark, self.ledger_name, events)

    def compact(self, contract: TableContract) -> None:
        """One or two events per entry of a table in place of all that were recorded.

        For a time when nothing else is recorded of that table.
        """
        with step_copy(book.events_of(self.ledger(contract), self.sequence())) as complete:
            tables.replace_partitions(self.spark, self.ledger_name, complete)

    def table_name(self, contract: TableContract) -> str:
        return f"{contract.source}.{contract.table}"

    def table(self, contract: TableContract) -> DataFrame:
        """The loaded table; created, or given the columns it lacks, as the contract asks."""
        self._open(contract)
        return tables.read(self.spark, self.table_name(contract))

    def _open(self, contract: TableContract) -> None:
        # Tables that rows are added to keep loads apart, so that a repeated load replaces itself.
        by = ([tables.LOAD] if contract.strategy in ADDING else []) + list(contract.partition_by)
        tables.create(self.spark, self.table_name(contract), contract.table_schema, self.table_root(contract), by)

    def table_root(self, contract: TableContract) -> str:
        return self.path("source", contract.source, contract.table)

    def step(self, step: str, contract: TableContract, batch_id: str) -> str:
        return self.path(step, contract.source, contract.table, f"batch={batch_id}")

    def review(self, contract: TableContract) -> DataFrame:
        """All quarantined rows of the table, over all batches."""
        return self.spark.read.option("mergeSchema", "true").parquet(
            self.path("review", contract.source, contract.table)
        )


@dataclass(frozen=True)
class Outcome:
    refused: DataFrame | None
    failures: DataFrame | None
    entries: DataFrame


def ingest_batch(
    store: Store,
    contract: TableContract,
    paths: str | Sequence[str],
    batch_id: str,
    at: datetime,
    on_refused: str = "raise",
    again: bool = False,
) -> Outcome:
    """Bring files into the contract's table.

    `batch_id` names this set of files. Running the same batch again, after a failure
    or a second delivery, changes nothing that is done: files whose entry reached
    "inserted" are left out, unless `again` asks for them. A batch that was cut off after
    staging goes on with exactly the files it had staged; files that came meanwhile wait
    for the next call. `on_refused` is "raise" or "skip" for files that do not fit the
    contract; skipped ones keep their entry at its stage. Two files of one name, in
    different folders, are refused: the name is a file's identity in the ledger.
    """
    spark = store.spark
    contract.check(spark)
    files = list_files(spark, paths).select(
        F.lit(contract.source).alias("source"), F.lit(contract.table).alias("table"), "file_name", "path"
    )
    _refuse_same_names(files)
    claimed = files.select(*book.FILE)
    store.record(book.register_events(store.entries(contract, claimed), claimed, at, store.sequence()))
    refused = None

    listed_at, staged_at = store.step("listed", contract, batch_id), store.step("staged", contract, batch_id)
    resumed = tables.is_complete(spark, listed_at) and tables.is_complete(spark, staged_at)
    if resumed:
        accepted = spark.read.schema(LISTED).parquet(listed_at)
        files = accepted.drop("run")
    else:
        if not again:
            todo = book.unfinished(store.entries(contract, claimed), claimed, "inserted")
            files = files.join(todo.select(*book.FILE), list(book.FILE), "left_semi")
        files = cut_lineage(files)
        if files.isEmpty():
            return Outcome(None, None, book.lookup(store.entries(contract, claimed), claimed))
        accepted = files
        if contract.has_header:
            audited = cut_lineage(audit(files, contract))
            refused = violations(audited)
            if on_refused == "raise":
                raise_refused(refused)
            accepted = files.join(audited.where("refused"), "path", "left_anti")
        # The run tells this set of files apart from others that had the same batch id.
        accepted = accepted.select("source", "table", "file_name", "path", F.lit(uuid.uuid4().hex[:12]).alias("run"))
        accepted.write.mode("overwrite").parquet(listed_at)
        accepted = spark.read.schema(LISTED).parquet(listed_at)
        if contract.has_header:
            rows = scan_audited(spark, audited, contract)
        else:
            # Spark's file index holds these names on the driver in any case.
            rows = scan(spark, [literal_path(r.path) for r in accepted.select("path").toLocalIterator()], contract)
        staged_rows(rows, contract).write.mode("overwrite").parquet(staged_at)
    staged = spark.read.schema(_staged_schema(contract)).parquet(staged_at)
    first = accepted.select("run").first()
    run = f"{batch_id}.{first.run}" if first else batch_id

    staged, stopped = proceeding(staged, contract)
    if stopped is not None:
        stopped = stopped.withColumnRenamed(FILE_NAME, "file_name")
        accepted = accepted.join(stopped, "file_name", "left_anti")
        gone = files.join(stopped, "file_name", "left_semi")
        store.record(book.drop_events(store.entries(contract, gone), gone, at, store.sequence()))
    read = book.count_rows(_as_entries(staged, contract))
    # Files without a row have a count too: zero.
    entries = cut_lineage(
        accepted.select(*book.FILE, F.lit(0).alias("increment"))
        .join(read, list(book.ENTRY), "left")
        .fillna(0, ["rows_read"])
    )
    held = store.entries(contract, entries)
    store.record(book.advance_events(held, entries, ["archived", "staged"], at, store.sequence(), rows_read=True))

    failures = _test_and_load(store, contract, staged, entries, run, at)
    remove_folder(spark, staged_at)
    remove_folder(spark, listed_at)
    return Outcome(refused, failures, book.lookup(store.entries(contract, claimed), claimed))


def _refuse_same_names(files: DataFrame) -> None:
    again = files.groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    some = again.orderBy("file_name").limit(20).collect()
    if some:
        names = [r.file_name for r in some]
        raise ValueError(f"{again.count()} file names occur more than once in the batch: {names}")


def ingest_review(
    store: Store,
    contract: TableContract,
    fixes: DataFrame,
    fix_keys: str | Sequence[str],
    batch_id: str,
    at: datetime,
) -> Outcome:
    """Quarantined rows, corrected by `fixes`, through test and load as their next attempt.

    Rows still failing go to quarantine again, one attempt further.
    """
    review = store.review(contract).drop("batch")
    waiting = cut_lineage(
        store.ledger(contract).where((F.col("increment") > 0) & F.col("date_completed").isNull())
    )
    attempts = waiting.select(F.col("file_name").alias(FILE_NAME), F.col("increment").alias(INCREMENT))
    due = filter_join(review, attempts, [FILE_NAME, INCREMENT], "left_semi")
    fixed = quality.requeue(due, fixes, fix_keys, increment="")
    # The attempts told apart: a second review under one id is another run.
    mark = waiting.agg(F.coalesce(F.bit_xor(F.xxhash64(*book.ENTRY)), F.lit(0))).first()[0]
    run = f"{batch_id}.review-{mark & 0xFFFFFFFFFFFF:012x}"
    failures = _test_and_load(store, contract, fixed, waiting.select(*book.ENTRY), run, at)
    return Outcome(None, failures, book.lookup(store.entries(contract, waiting), waiting))


def _as_entries(staged: DataFrame, contract: TableContract, *more: str) -> DataFrame:
    return staged.select(
        F.lit(contract.source).alias("source"),
        F.lit(contract.table).alias("table"),
        F.col(FILE_NAME).alias("file_name"),
        F.col(INCREMENT).alias("increment"),
        *more,
    )


def _test_and_load(
    store: Store, contract: TableContract, staged: DataFrame, entries: DataFrame, run: str, at: datetime
) -> DataFrame:
    """Mark, quarantine, load and complete; returns the failures by file and rule.

    `run` names these rows: a repeat of the run goes on with what it has written.
    """
    spark = store.spark
    marked_at = store.step("marked", contract, run)
    if not tables.is_complete(spark, marked_at):
        marked = quality.mark(staged, contract.rules, scope=(FILE_NAME, INCREMENT), measured=True)
        # The load time is fixed here, so that a repeated load offers the same rows.
        dated = marked.withColumns({"_datetime_added": stamp(at), CLEAN: F.size(quality.FAILED) == 0})
        if contract.absent != "keep":  # of clean rows nothing reads it then
            dated = dated.withColumn(PRESENT, F.when(~F.col(CLEAN), quoted(PRESENT)))
        # Both parts are written side by side, which spares sorting the rows by them.
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
            dated.write.mode("overwrite").partitionBy(CLEAN).parquet(marked_at)
    marked = spark.read.schema(_marked_schema(contract)).parquet(marked_at)
    failing = marked.where(~F.col(CLEAN)).drop(CLEAN, "_datetime_added")
    failures = cut_lineage(quality.failures(failing, [FILE_NAME, INCREMENT]))
    counts = failing.groupBy(FILE_NAME, INCREMENT).agg(F.count(F.lit(1)).alias("rows_failed"))

    failing.withColumn(INCREMENT, F.col(INCREMENT) + 1).write.mode("overwrite").parquet(
        store.step("review", contract, run)
    )
    held, seq = store.entries(contract, entries), store.sequence()
    reviews = book.review_entries(_as_entries(counts, contract, "rows_failed"), at)
    cleaned = book.advance_events(held, entries, "cleaned", at, seq)
    store.record(cleaned.unionByName(book.entry_events(held, reviews, seq)))

    clean = marked.where(F.col(CLEAN)).drop(CLEAN, quality.FAILED)
    _load_table(store, contract, clean, run)
    held = store.entries(contract, entries)
    store.record(book.advance_events(held, entries, ["inserted", "completed"], at, store.sequence()))
    # The copies go once the entries say so; a crash in between leaves them behind.
    remove_folder(spark, marked_at)
    remove_folder(spark, store.step("state", contract, run))
    return failures


def _staged_schema(contract: TableContract) -> T.StructType:
    return T.StructType(
        [
            *contract.schema.fields,
            T.StructField(RECORD, T.StringType()),
            T.StructField(FILE_NAME, T.StringType()),
            T.StructField(FILE_TIME, T.TimestampType()),
            T.StructField(FOLDER, T.StringType()),
            T.StructField(PRESENT, T.ArrayType(T.StringType())),
            T.StructField(INCREMENT, T.IntegerType()),
            T.StructField(HASH, T.IntegerType()),
        ]
    )


def _marked_schema(contract: TableContract) -> T.StructType:
    return T.StructType(
        [
            *_staged_schema(contract).fields,
            T.StructField(quality.FAILED, T.ArrayType(T.StringType())),
            T.StructField("_datetime_added", T.TimestampType()),
            T.StructField(CLEAN, T.BooleanType()),
        ]
    )


def _load_table(store: Store, contract: TableContract, clean: DataFrame, run: str) -> None:
    """Bring the clean rows into the table; a repeat of the run leaves the same table."""
    spark, name = store.spark, store.table_name(contract)
    target = store.table(contract)
    _finish_states(store, contract, run)
    if clean.isEmpty():
        return
    columns = [c for c in clean.columns if c in target.columns]
    rows = clean.select(*[quoted(c) for c in columns])
    if contract.strategy == "insert":
        tables.append(spark, name, align(rows, target.schema), load=run)
        return
    if contract.strategy == "replace":
        if not clean.where(F.col(INCREMENT) > 0).isEmpty():  # corrected rows belong to the load they came with
            tables.append(spark, name, align(rows, target.schema), load=run)
            return
        only = _last_delivery(clean, contract).select(*[quoted(c) for c in columns])
        tables.publish_complete(spark, name, align(only, target.schema), store.table_root(contract), load=run)
        return

    pick = "first" if contract.strategy == "merge_insert" else "latest"
    chosen, copies = clean, has_copies(clean, contract.keys)
    # Without a key that occurs twice there is none that several files hold.
    if copies and clean.select(FILE_TIME, FILE_NAME).distinct().limit(2).count() > 1:
        chosen = from_one_file(clean, contract.keys, [FILE_TIME, FILE_NAME], pick)
    offered = chosen.select(*[quoted(c) for c in columns], *([quoted(PRESENT)] if contract.absent == "keep" else []))
    unique = not copies or (chosen is not clean and not has_copies(offered, contract.keys))
    options = {"on_duplicate": contract.on_duplicate, "unique": unique}
    if contract.on_duplicate in ("latest", "first"):
        offered = offered.withColumns({FILE_TIME: chosen[FILE_TIME], FILE_NAME: chosen[FILE_NAME]})
        options["order_by"] = [FILE_TIME, FILE_NAME]
    if contract.absent == "keep":
        options["present"] = PRESENT

    if contract.strategy == "merge_insert":
        held = tables.others(spark, name, run)
        tables.append(spark, name, new_rows(held, offered, contract.keys, **options), load=run)
        return
    if target.isEmpty():
        target = target.limit(0)  # says so to the planner: the rows are not joined with nothing
    else:
        options["large"] = outgrows_broadcast(offered)
    state_at = store.step("state", contract, run)
    if not tables.is_complete(spark, state_at):
        before = _touched(target, offered, contract) if contract.partition_by else target
        state = load(before, offered, contract.strategy, contract.keys, **options)
        state.write.mode("overwrite").parquet(state_at)
    _apply_state(store, contract, state_at)


def _last_delivery(clean: DataFrame, contract: TableContract) -> DataFrame:
    """The rows of the file, or of all files of the folder, that came last."""
    unit = FOLDER if contract.delivery == "folder" else FILE_NAME
    last = clean.groupBy(unit).agg(F.max(FILE_TIME).alias("at")).agg(F.max(F.struct("at", unit)).alias("f")).first().f
    return clean.where(F.col(unit) == F.lit(last[unit]))


def _apply_state(store: Store, contract: TableContract, state_at: str) -> None:
    """Overwrite the table, or the partitions that occur, by a state that is complete elsewhere."""
    spark, name = store.spark, store.table_name(contract)
    state = spark.read.schema(store.table(contract).schema).parquet(state_at)
    if contract.partition_by:
        tables.replace_partitions(spark, name, state)
    else:
        tables.publish_complete(spark, name, state, store.table_root(contract))


def _finish_states(store: Store, contract: TableContract, run: str) -> None:
    """Apply what an earlier run of the table may have left half applied, before anything reads the table."""
    spark, root = store.spark, store.path("state", contract.source, contract.table)
    for folder in tables.folders(spark, root):  # one at most, unless runs were cut off
        left = f"{root}/{folder}"
        if left != store.step("state", contract, run) and tables.is_complete(spark, left):
            _apply_state(store, contract, left)
            remove_folder(spark, left)


def _touched(target: DataFrame, offered: DataFrame, contract: TableContract) -> DataFrame:
    """The table's rows in partitions that the offered rows name, NULL being a partition too.

    The values of each partition column, which are as many as the batch has partitions,
    prune the scan; the semi join picks the combinations.
    """
    names = list(contract.partition_by)
    values = cut_lineage(offered.select(*[quoted(p) for p in names]).distinct())
    for p in names:
        held = [r[0] for r in values.select(quoted(p)).distinct().toLocalIterator()]
        named = quoted(p).isin([v for v in held if v is not None])
        target = target.where(named | quoted(p).isNull() if None in held else named)
    if len(names) == 1:
        return target
    wanted = values.select(*[quoted(p).alias(f"__p_{p}") for p in names])
    same = F.lit(True)
    for p in names:
        same = same & quoted(p).eqNullSafe(quoted(f"__p_{p}"))
    return target.join(wanted, same, "left_semi")


def abandon_files(store: Store, contract: TableContract, claims: DataFrame, batch_id: str) -> DataFrame:
    """Give up attempts (file_name, increment) of a batch; returns those refused.

    Their staged rows go, if the batch has staged any.
    """
    spark = store.spark
    named = claims.select(
        F.lit(contract.source).alias("source"), F.lit(contract.table).alias("table"), "file_name", "increment"
    )
    path, left = store.step("staged", contract, batch_id), store.step("staged-left", contract, batch_id)
    has_rows = tables.is_complete(spark, path)
    staged = (
        spark.read.schema(_staged_schema(contract)).parquet(path)
        if has_rows
        else spark.createDataFrame([], _staged_schema(contract))
    )
    held = store.entries(contract, named)
    result = book.abandon(held, staged, named, {"file_name": FILE_NAME, "increment": INCREMENT})
    refused = cut_lineage(result.refused)
    if has_rows:
        result.staged.write.mode("overwrite").parquet(left)
        spark.read.schema(_staged_schema(contract)).parquet(left).write.mode("overwrite").parquet(path)
        remove_folder(spark, left)
    ended = filter_join(book.lookup(held, named), refused, list(book.ENTRY), "left_anti").where("increment = 0")
    store.record(book.drop_events(held, ended, F.current_timestamp(), store.sequence()))
    _unlist(store, contract, named, refused, batch_id)
    return refused


def _unlist(store: Store, contract: TableContract, named: DataFrame, refused: DataFrame, batch_id: str) -> None:
    """Take given-up files off the staged batch's list, so that they can be taken again."""
    spark = store.spark
    listed_at, left = store.step("listed", contract, batch_id), store.step("listed-left", contract, batch_id)
    if not tables.is_complete(spark, listed_at):
        return
    gone = filter_join(named, refused, list(book.ENTRY), "left_anti").where("increment = 0")
    filter_join(spark.read.schema(LISTED).parquet(listed_at), gone, list(book.FILE), "left_anti").write.mode(
        "overwrite"
    ).parquet(left)
    kept = spark.read.schema(LISTED).parquet(left)
    if kept.isEmpty():
        remove_folder(spark, store.step("staged", contract, batch_id))
        remove_folder(spark, listed_at)
    else:
        kept.write.mode("overwrite").parquet(listed_at)
    remove_folder(spark, left)


def rename_table(store: Store, source: str, old: str, to: str) -> None:
    """Move a table to a new name, with its partitioning: rows, then the ledger, then the old files go.

    A repeat after a crash starts from the old table as long as the ledger has the old name.
    """
    spark = store.spark
    before = store.ledger().where((F.col("source") == source) & (F.col("table") == old))
    renamed = book.rename_table(before, source, old, to)
    name, root = f"{source}.{old}", store.path("source", source, old)
    held = tables.has_data(spark, root)
    if held:
        rows = book.rekey_rows(tables.read(spark, name), renamed.mapping)
        by = tables.partition_columns(spark, name)
        tables.publish(spark, f"{source}.{to}", rows, store.path("source", source, to), by)
    seq = store.sequence()
    gone = book.drop_events(before, before, F.current_timestamp(), seq)
    store.record(book.events_of(renamed.ledger, seq).unionByName(gone))
    tables.drop(spark, name, root)
