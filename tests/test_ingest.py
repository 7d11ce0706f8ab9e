"""Whole loads: what a second load of the same file restores, per strategy, and the way around failures."""

import dataclasses
import os
import time
from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import ContractError, TableContract
from tidegate.operators import ledger as book
from tidegate.operators.quality import NotNull, Unique
from tidegate.plans import ingest
from tidegate.plans.ingest import Store, abandon_files, ingest_batch, ingest_review, rename_table
from tidegate.sources import tables
from tidegate.streaming.arrivals import ingest_arrivals

COLUMNS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DecimalType(18, 9)),
        T.StructField("close", T.DecimalType(18, 9)),
        T.StructField("volume", T.IntegerType()),
        T.StructField("height", T.TimestampType()),
        T.StructField("isGood", T.BooleanType()),
    ]
)
NAMES = COLUMNS.fieldNames()
OPTIONS = {"sep": ",", "header": True, "dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
T1 = datetime(2024, 1, 1)


def at(step):
    return T1 + timedelta(days=step)


def days(first=datetime(2017, 1, 1), count=60):
    """One valid line per day."""
    lines = {}
    for i in range(count):
        day = (first + timedelta(days=i)).strftime("%Y-%m-%d")
        lines[day] = [day, f"{i}.25", f"{i}.5", str(1000 + i), f"{day} 10:11:12", str(i % 2 == 0)]
    return lines


def write(folder, name, lines, header=NAMES):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([",".join(header), *[",".join(line) for line in lines]]) + "\n")


@pytest.fixture
def world(spark, fresh):
    folder, name = fresh
    store = Store(spark, folder + "/store", f"{name}_ledger.import_file")
    rules = (Unique("date"), *[NotNull(n) for n in NAMES])
    contract = TableContract(name, "table0", COLUMNS, keys=("date",), options=OPTIONS, rules=rules)
    return store, contract, folder + "/raw"


def data(store, contract):
    return store.table(contract).select(*contract.schema.fieldNames())


def stages(store):
    return {(r.file_name, r.increment): r.stage for r in book.with_stage(store.ledger()).collect()}


def test_happy_path(world):
    store, contract, raw = world
    write(raw, "file0.csv", days().values())
    outcome = ingest_batch(store, contract, raw, "b1", T1)
    table = store.table(contract)
    assert table.count() == 60
    assert table.where(" OR ".join(f"`{n}` IS NULL" for n in table.columns)).count() == 0
    assert {r._datetime_added for r in table.collect()} == {T1}
    entry = outcome.entries.first()
    assert (entry.rows_read, entry.date_completed) == (60, T1)
    assert {r._hash for r in table.select("_hash").distinct().collect()} == {entry.hash}
    assert outcome.failures.count() == 0
    for step in ("staged", "marked"):
        assert not tables.is_complete(store.spark, store.step(step, contract, "b1"))


@pytest.mark.parametrize("strategy", ["merge_update", "merge_insert", "insert", "replace"])
def test_loading_the_file_again(world, strategy):
    store, contract, raw = world
    contract = dataclasses.replace(contract, strategy=strategy)
    write(raw, "file0.csv", days().values())
    ingest_batch(store, contract, raw, "b1", at(0))
    original = rows(data(store, contract))

    gone = F.day("date") == 5
    damaged = (
        store.table(contract)
        .where(~gone)
        .withColumn("volume", F.when(F.day("date") == 7, F.col("volume") + 10).otherwise(F.col("volume")))
        .withColumn("isGood", F.when(F.day("date") == 8, ~F.col("isGood")).otherwise(F.col("isGood")))
        .withColumn("height", F.when(F.day("date") == 9, F.col("height") + F.expr("INTERVAL '10' MINUTE")).otherwise(F.col("height")))
    )
    if strategy == "replace":
        damaged = damaged.withColumn("date", F.date_add("date", 1000)).unionByName(store.table(contract).where(gone))
    tables.publish(store.spark, store.table_name(contract), damaged, store.table_root(contract))
    before = rows(data(store, contract))
    ingest_batch(store, contract, raw, "b2", at(1), again=True)
    after = store.table(contract)
    found = rows(data(store, contract))

    if strategy == "merge_update":
        assert found == original
        touched = F.day("date").isin(5, 7, 8, 9)
        assert after.where(touched & (F.col("_datetime_added") != F.lit("2024-01-02").cast("timestamp"))).count() == 0
        assert after.where(~touched & (F.col("_datetime_added") != F.lit("2024-01-01").cast("timestamp"))).count() == 0
    elif strategy == "merge_insert":
        assert set(before) <= set(found) and len(found) == len(original)
        restored = [r for r in found if r not in before]
        assert restored and all(r[0].day == 5 and r in original for r in restored)
    elif strategy == "insert":
        assert found == sorted(before + original, key=repr)
        counts = {r["date"].day: r["count"] for r in after.groupBy("date").count().collect()}
        assert counts[5] == 1 and counts[6] == 2
    else:
        assert found == original


def bad_lines():
    lines = days()
    broken = list(lines.values())
    broken[3][1] = "abc"
    broken[10][2] = "def"
    broken[20][3] = "True"
    broken[30][4] = "6"
    broken[40][5] = ""
    return broken


def test_quarantine_and_its_way_back(world):
    store, contract, raw = world
    contract = dataclasses.replace(contract, strategy="insert")
    write(raw, "file1.csv", bad_lines())
    outcome = ingest_batch(store, contract, raw, "b1", at(0))
    clean, review = store.table(contract), store.review(contract)
    assert (clean.count(), review.count()) == (55, 5)
    assert {(r.rule, r.rows_failed) for r in outcome.failures.collect()} == {(f"not_null({n})", 1) for n in NAMES[1:]}
    assert all(len(r._failed_rules) == 1 and r._increment == 1 for r in review.collect())
    assert review.select(*NAMES).schema == clean.select(*NAMES).schema
    assert stages(store) == {("file1.csv", 0): "completed", ("file1.csv", 1): "staged"}
    assert store.ledger().where("increment = 1").first().rows_read == 5

    good = store.spark.createDataFrame([(line[0], line[3]) for line in days().values()], "date string, volume string")
    fixes = good.select(F.to_date("date").alias("date"), F.col("volume").cast("int").alias("volume"))
    ingest_review(store, contract, fixes, "date", "r1", at(1))
    assert (store.table(contract).count(), stages(store)[("file1.csv", 1)], stages(store)[("file1.csv", 2)]) == (56, "completed", "staged")
    opens = store.spark.createDataFrame([(line[0], line[1]) for line in days().values()], "date string, open string")
    fixes = opens.select(F.to_date("date").alias("date"), F.col("open").cast("decimal(18,9)").alias("open"))
    ingest_review(store, contract, fixes, "date", "r2", at(2))
    assert store.table(contract).count() == 57
    assert store.table(contract).select("date").distinct().count() == 57


def test_a_batch_twice_changes_nothing(world):
    store, contract, raw = world
    contract = dataclasses.replace(contract, strategy="insert")
    write(raw, "file0.csv", days().values())
    ingest_batch(store, contract, raw, "b1", at(0))
    before, ledger = rows(data(store, contract)), rows(store.ledger())
    ingest_batch(store, contract, raw, "b1", at(1))
    assert rows(data(store, contract)) == before and rows(store.ledger()) == ledger


@pytest.mark.parametrize("strategy", ["insert", "merge_update"])
@pytest.mark.parametrize("where", ["_load_table", "record"])
def test_restart_after_a_failure(world, monkeypatch, strategy, where):
    store, contract, raw = world
    contract = dataclasses.replace(contract, strategy=strategy)
    write(raw, "file0.csv", bad_lines())
    with monkeypatch.context() as patch:
        if where == "_load_table":
            load = ingest._load_table

            def fail_after(*args):
                load(*args)
                raise RuntimeError("lost")

            patch.setattr(ingest, "_load_table", fail_after)
        else:
            record, calls = Store.record, []

            def fail_third(self, events):
                calls.append(1)
                if len(calls) == 3:
                    raise RuntimeError("lost")
                record(self, events)

            patch.setattr(Store, "record", fail_third)
        with pytest.raises(RuntimeError, match="lost"):
            ingest_batch(store, contract, raw, "b1", at(0))
    assert stages(store)[("file0.csv", 0)] in ("staged", "cleaned")
    ingest_batch(store, contract, raw, "b1", at(3))
    assert store.table(contract).count() == 55
    assert {r._datetime_added for r in store.table(contract).select("_datetime_added").distinct().collect()} == {at(0)}
    assert stages(store) == {("file0.csv", 0): "completed", ("file0.csv", 1): "staged"}
    assert store.review(contract).count() == 5


def test_several_files_as_if_one_after_the_other(world):
    store, contract, raw = world
    write(raw, "a.csv", days(count=10).values())
    later = days(count=12)
    for line in later.values():
        line[3] = "5"
    time.sleep(0.05)
    write(raw, "b.csv", [line[::-1] for line in later.values()], NAMES[::-1])
    write(raw, "none.csv", [])
    for strategy, volumes in {"merge_update": 12, "merge_insert": 2, "replace": 12}.items():
        chosen = dataclasses.replace(contract, strategy=strategy, table=f"t_{strategy}")
        ingest_batch(store, chosen, raw, "b1", at(0))
        table = store.table(chosen)
        assert (table.count(), table.where("volume = 5").count()) == (12, volumes), strategy
    read = {r.file_name: r.rows_read for r in store.ledger().where("`table` = 't_replace'").collect()}
    assert read == {"a.csv": 10, "b.csv": 12, "none.csv": 0}
    assert set(stages(store).values()) == {"completed"}


def test_refused_files_wait(world):
    store, contract, raw = world
    write(raw, "a.csv", days(count=3).values())
    write(raw, "extra.csv", [["2020-01-01", "1"]], ["date", "surplus"])
    with pytest.raises(ContractError, match="surplus"):
        ingest_batch(store, contract, raw, "b1", at(0))
    assert set(stages(store).values()) == {"new"}
    outcome = ingest_batch(store, contract, raw, "b1", at(0), on_refused="skip")
    assert outcome.refused.count() == 1 and store.table(contract).count() == 3
    assert stages(store) == {("a.csv", 0): "completed", ("extra.csv", 0): "new"}


def test_preprocessing_may_turn_a_file_away(world):
    store, contract, raw = world
    write(raw, "a.csv", days(count=3).values())
    write(raw, "b.csv", days(datetime(2018, 1, 1), 4).values())
    judged = dataclasses.replace(
        contract, preprocess=lambda df: df.withColumn("volume", F.col("volume") * 2), proceed=F.count(F.lit(1)) > 3
    )
    ingest_batch(store, judged, raw, "b1", at(0))
    assert store.table(judged).count() == 4 and store.table(judged).where("volume % 2 = 1").count() == 0
    assert stages(store) == {("b.csv", 0): "completed"}


def test_columns_may_be_added(world):
    store, contract, raw = world
    narrow = dataclasses.replace(contract, columns=T.StructType(COLUMNS.fields[:3]), rules=())
    write(raw + "/1", "a.csv", [line[:3] for line in days(count=3).values()], NAMES[:3])
    ingest_batch(store, narrow, raw + "/1", "b1", at(0))
    wide = dataclasses.replace(contract, rules=())
    write(raw + "/2", "b.csv", days(count=4).values())
    ingest_batch(store, wide, raw + "/2", "b2", at(1))
    table = store.table(wide)
    assert table.count() == 4 and table.where("volume IS NULL").count() == 0


def test_absent_columns_null_or_keep(world):
    store, contract, raw = world
    write(raw + "/1", "a.csv", days(count=2).values())
    write(raw + "/2", "b.csv", [line[:3] for line in days(count=3).values()], NAMES[:3])
    for absent, kept in (("null", 0), ("keep", 2)):
        chosen = dataclasses.replace(contract, rules=(), absent=absent, table=f"t_{absent}")
        ingest_batch(store, chosen, raw + "/1", "b1", at(0))
        ingest_batch(store, chosen, raw + "/2", "b2", at(1))
        table = store.table(chosen)
        assert (table.count(), table.where("volume IS NOT NULL").count()) == (3, kept)


def test_only_touched_partitions_are_rewritten(world):
    store, contract, raw = world
    columns = T.StructType([T.StructField("month", T.IntegerType()), *COLUMNS.fields])
    parted = dataclasses.replace(
        contract, columns=columns, keys=("month", "date"), partition_by=("month",), rules=(NotNull("month"),)
    )
    header = ["month", *NAMES]
    lines = [[str(int(line[0][5:7])), *line] for line in days(count=70).values()]
    write(raw + "/1", "a.csv", lines, header)
    ingest_batch(store, parted, raw + "/1", "b1", at(0))
    first = {r.month: r.f for r in store.table(parted).select("month", F.input_file_name().alias("f")).distinct().collect()}
    changed = [[*line[:4], "1", *line[5:]] for line in lines if line[0] == "2"]
    write(raw + "/2", "b.csv", changed, header)
    ingest_batch(store, parted, raw + "/2", "b2", at(1))
    second = {r.month: r.f for r in store.table(parted).select("month", F.input_file_name().alias("f")).distinct().collect()}
    assert first[1] == second[1] and first[3] == second[3] and first[2] != second[2]
    table = store.table(parted)
    assert table.count() == 70 and table.where("volume = 1").count() == 28 and table.where("month = 2 AND volume = 1").count() == 28


def test_abandon(world, monkeypatch):
    store, contract, raw = world
    write(raw, "a.csv", days(count=3).values())
    write(raw, "b.csv", days(datetime(2018, 1, 1), 4).values())
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_test_and_load", lambda *args: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError, match="stop"):
            ingest_batch(store, contract, raw, "b1", at(0))
    claims = store.spark.createDataFrame([("a.csv", 0)], "file_name string, increment int")
    assert abandon_files(store, contract, claims, "b1").count() == 0
    assert stages(store) == {("b.csv", 0): "staged"}
    ingest_batch(store, contract, f"{raw}/b.csv", "b1", at(0))
    assert store.table(contract).count() == 4
    claims = store.spark.createDataFrame([("b.csv", 0)], "file_name string, increment int")
    assert [(r.file_name, r.stage) for r in abandon_files(store, contract, claims, "b1").collect()] == [("b.csv", "completed")]


def test_rename(world):
    store, contract, raw = world
    write(raw, "a.csv", days(count=3).values())
    ingest_batch(store, contract, raw, "b1", at(0))
    rename_table(store, contract.source, "table0", "other")
    renamed = dataclasses.replace(contract, table="other")
    assert store.table(renamed).count() == 3 and not tables.exists(store.spark, f"{contract.source}.table0")
    entry = store.ledger().first()
    assert entry.table == "other" and {r._hash for r in store.table(renamed).collect()} == {entry.hash}


def test_arrivals_are_taken_once(world):
    store, contract, raw = world
    checkpoint, archive = store.path("checkpoint"), store.root + "/archive"
    write(raw, "a.csv", days(count=3).values())

    def run():
        query = ingest_arrivals(store, contract, raw, checkpoint, archive)
        assert query.awaitTermination(240)

    run()
    assert store.table(contract).count() == 3
    first = rows(store.ledger())
    run()
    assert rows(store.ledger()) == first
    write(raw, "b.csv", days(datetime(2018, 1, 1), 4).values())
    run()
    assert store.table(contract).count() == 7 and len(stages(store)) == 2
    write(raw, "c.csv", days(datetime(2019, 1, 1), 2).values())
    run()
    assert store.table(contract).count() == 9
    archived = [f for _, _, found in os.walk(archive) for f in found if f.endswith(".csv")]
    assert "a.csv" in archived and not os.path.exists(f"{raw}/a.csv")


def test_tables(spark, fresh):
    folder, name = fresh
    tables.create(spark, f"{name}.t", T.StructType([T.StructField("a", T.IntegerType())]), folder)
    assert tables.exists(spark, f"{name}.t") and tables.read(spark, f"{name}.t").count() == 0
    tables.append(spark, f"{name}.t", spark.createDataFrame([(1,)], "a int"))
    tables.publish(spark, f"{name}.t", tables.read(spark, f"{name}.t").union(tables.read(spark, f"{name}.t")), folder)
    assert rows(tables.read(spark, f"{name}.t")) == [(1,), (1,)]
    tables.clear(spark, f"{name}.t")
    assert tables.read(spark, f"{name}.t").count() == 0
    tables.drop(spark, f"{name}.t")
    assert not tables.exists(spark, f"{name}.t")


def test_partition_values_of_any_kind(world):
    store, contract, raw = world
    columns = T.StructType([T.StructField("place", T.StringType()), T.StructField("seen", T.TimestampType()), T.StructField("n", T.IntegerType())])
    parted = dataclasses.replace(contract, columns=columns, keys=("place", "seen", "n"), partition_by=("place", "seen"), rules=())
    header = ["place", "seen", "n"]
    first = [["Rome", "2024-01-01 10:00:00", "1"], ["Oslo", "2024-01-01 10:00:00", "2"], ["", "2024-01-01 10:00:00", "3"]]
    second = [["New York's = 1%", "2024-01-01 10:30:00", "4"], ["Rome", "2024-01-01 10:00:00", "1"], ["Rome", "", "5"]]
    write(raw + "/1", "a.csv", first, header)
    write(raw + "/2", "b.csv", second, header)
    ingest_batch(store, parted, raw + "/1", "b1", at(0))
    ingest_batch(store, parted, raw + "/2", "b2", at(1))
    got = {(r.place, str(r.seen), r.n) for r in store.table(parted).collect()}
    assert got == {
        ("Rome", "2024-01-01 10:00:00", 1), ("Oslo", "2024-01-01 10:00:00", 2), (None, "2024-01-01 10:00:00", 3),
        ("New York's = 1%", "2024-01-01 10:30:00", 4), ("Rome", "None", 5),
    }
    assert store.table(parted).where("place = 'Rome'").count() == 2
    rename_table(store, contract.source, "table0", "moved")
    moved = dataclasses.replace(parted, table="moved")
    write(raw + "/3", "c.csv", [["Rome", "2024-01-01 10:00:00", "6"]], header)
    ingest_batch(store, moved, raw + "/3", "b3", at(2))
    assert store.table(moved).count() == 6


def test_same_name_in_two_folders_is_refused(world):
    store, contract, raw = world
    write(raw + "/x", "a.csv", days(count=2).values())
    write(raw + "/y", "a.csv", days(count=3).values())
    with pytest.raises(ValueError, match="more than once"):
        ingest_batch(store, contract, [raw + "/x", raw + "/y"], "b1", at(0))


def test_abandoned_file_can_come_again_under_its_batch(world, monkeypatch):
    store, contract, raw = world
    write(raw, "a.csv", days(count=3).values())
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_test_and_load", lambda *args: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError, match="stop"):
            ingest_batch(store, contract, raw, "b1", at(0))
    claims = store.spark.createDataFrame([("a.csv", 0)], "file_name string, increment int")
    abandon_files(store, contract, claims, "b1")
    ingest_batch(store, contract, raw, "b1", at(0))
    assert store.table(contract).count() == 3


def test_second_run_of_a_batch_keeps_earlier_review_rows(world):
    store, contract, raw = world
    bad = [[d, "abc", *rest] for d, _, *rest in days(count=2).values()]
    write(raw, "a.csv", bad)
    ingest_batch(store, contract, raw, "b1", at(0))
    write(raw, "b.csv", [["2019-01-01", "abc", "1.5", "1", "2019-01-01 10:11:12", "true"]])
    ingest_batch(store, contract, raw, "b1", at(1))
    assert store.review(contract).count() == 3


def test_names_with_glob_characters(world):
    store, contract, raw = world
    for i, name in enumerate(("a[1].csv", "b{x,y}.csv", "c*.csv")):
        write(raw, name, days(datetime(2018 + i, 1, 1), 2).values())
    ingest_batch(store, contract, raw, "b1", at(0))
    assert store.table(contract).count() == 6


def test_another_process_goes_on_with_the_store(world):
    store, contract, raw = world
    write(raw, "a.csv", days(count=3).values())
    ingest_batch(store, contract, raw, "b1", at(0))
    name, ledger = store.table_name(contract), store.ledger_name
    spark = store.spark
    for known in (name, ledger):  # what a new session's catalog does not know
        spark.sql(f"DROP TABLE {known}")
    again = Store(spark, store.root, ledger)
    assert again.table(contract).count() == 3 and again.ledger().count() == 1
    ingest_batch(again, contract, raw, "b1", at(0))
    write(raw, "b.csv", days(datetime(2018, 1, 1), 4).values())
    ingest_batch(again, contract, raw, "b2", at(1))
    assert again.table(contract).count() == 7


def test_a_load_is_appended_once(spark, fresh):
    folder, name = fresh
    tables.create(spark, f"{name}.t", T.StructType([T.StructField("a", T.IntegerType())]), folder, [tables.LOAD])
    one = spark.createDataFrame([(1,)], "a int")
    for _ in range(2):
        tables.append(spark, f"{name}.t", one, load="first")
    tables.append(spark, f"{name}.t", one, load="second")
    assert tables.read(spark, f"{name}.t").count() == 2


def test_repeated_updates_and_colliding_hashes(spark):
    from tidegate.operators.dml import update_from

    rows_ = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError, match="share a key"):
        update_from(rows_, twice, "k")
    # Two files under one hash: rows are neither multiplied nor lost.
    ledger = book.entries_for(
        spark.createDataFrame([("s", "t", "a"), ("s", "t", "b")], "source string, table string, file_name string"), at(0)
    ).withColumn("hash", F.lit(7))
    renamed = book.rename_table(ledger, "s", "t", "u")
    held = spark.createDataFrame([(7, 1), (7, 2), (7, 3)], "_hash int, n int")
    moved = book.rekey_rows(held, renamed.mapping)
    assert moved.count() == 3 and renamed.ledger.count() == 2
    assert {r._hash for r in moved.collect()} == {r.hash for r in renamed.ledger.collect()}


def test_files_without_a_common_key_are_not_weighed_against_each_other(world, monkeypatch):
    """Choosing a file per key joins the whole batch with itself; an empty table is joined with nothing."""
    store, contract, raw = world
    write(raw, "a.csv", days(count=20).values())
    write(raw, "b.csv", days(datetime(2018, 1, 1), 20).values())
    monkeypatch.setattr(ingest, "from_one_file", lambda *_: pytest.fail("no two files hold one key"))
    monkeypatch.setattr(ingest, "outgrows_broadcast", lambda *_: pytest.fail("the table is empty"))
    ingest_batch(store, contract, raw, "b1", T1)
    assert data(store, contract).count() == 40


def test_clean_rows_keep_no_copy_of_their_header(world, monkeypatch):
    """Nothing reads it of them; of quarantined rows it stays."""
    store, contract, raw = world
    lines = days(count=4)
    write(raw, "a.csv", [*lines.values(), ["2019-01-01", "abc", *lines["2017-01-01"][2:]]])
    seen = []
    load_table = ingest._load_table
    monkeypatch.setattr(ingest, "_load_table", lambda s, c, clean, run: (seen.extend(clean.collect()), load_table(s, c, clean, run)))
    ingest_batch(store, contract, raw, "b1", T1)
    assert {r._present for r in seen} == {None} and len(seen) == 4
    assert [r._present for r in store.review(contract).collect()] == [NAMES]
    assert data(store, contract).count() == 4
