"""The ledger as appended events, loads that only append, and update merges by one outer join."""

import os
import random
from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import TableContract
from tidegate.operators import ledger as book
from tidegate.operators import merge as merging
from tidegate.operators.merge import merge, new_rows
from tidegate.operators.sizing import heavy_hitters, key_mark, outgrows_broadcast
from tidegate.plans.ingest import Store, ingest_batch

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def files(spark, *names, increment=0):
    return spark.createDataFrame(
        [("s", "t", n, increment) for n in names], "source string, table string, file_name string, increment int"
    )


def test_fold_equals_the_operations(spark):
    """The same walk by frames and by events gives the same ledger."""
    a, b, c = files(spark, "a"), files(spark, "b"), files(spark, "c")
    both = a.union(b)
    counts = b.withColumn("rows_read", F.lit(7))
    names = a.withColumn("processed_file_name", F.lit("a2"))
    state = book.register(book.empty(spark), both.union(c), T1).ledger
    state = book.advance(state, both, ["archived", "staged"], T2)
    state = book.advance(state, counts, "archived", T3, rows_read=True)
    state = book.set_processed_name(state, names, T3)
    state = book.register(state, both, T3).ledger  # nothing new
    state = book.register(state, files(spark, "b", increment=1), T3, ["archived", "staged"]).ledger
    state = book.drop_entries(state, c)

    events = spark.createDataFrame([], book.EVENTS)

    def say(fresh):
        nonlocal events
        events = spark.createDataFrame(events.collect() + fresh.select(events.columns).collect(), book.EVENTS)

    say(book.register_events(book.fold(events), both.union(c), T1, 1))
    say(book.advance_events(book.fold(events), both, ["archived", "staged"], T2, 2))
    say(book.advance_events(book.fold(events), counts, "archived", T3, 3, rows_read=True))
    say(book.processed_name_events(book.fold(events), names, T3, 4))
    before = events.count()
    say(book.register_events(book.fold(events), both, T3, 5))
    say(book.advance_events(book.fold(events), both, "staged", T3, 6))
    assert events.count() == before  # what changes nothing is not said
    say(book.register_events(book.fold(events), files(spark, "b", increment=1), T3, 7, ["archived", "staged"]))
    say(book.drop_events(book.fold(events), c, T3, 8))
    assert rows(book.fold(events)) == rows(state)
    say(events.limit(0).union(events))  # a repeat of everything but the order in which it came
    assert rows(book.fold(events)) == rows(state)
    assert rows(book.fold(book.events_of(state, 9))) == rows(state)
    again = spark.createDataFrame(events.collect() + book.register_events(book.fold(events), c, T3, 10).collect(), book.EVENTS)
    held = book.fold(again).where("file_name = 'c'").first()
    assert (held.date_new, held.date_archived, held._date_row_inserted) == (T3, None, T3)
    plan = book.fold(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def bytes_below(folder):
    return {os.path.join(f, n): os.path.getsize(os.path.join(f, n)) for f, _, found in os.walk(folder) for n in found if n.endswith(".parquet")}


def contract_of(name, **more):
    columns = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    return TableContract(name, "t", columns, keys=("k",), options={"header": True}, **more)


def test_a_batch_writes_its_own_entries_only(spark, fresh):
    folder, name = fresh
    store = Store(spark, folder, f"{name}_l.import_file")
    contract = contract_of(name)

    def batch(numbers):
        given = spark.range(*numbers).select(
            F.lit(name).alias("source"), F.lit("t").alias("table"), F.format_string("f%08d", "id").alias("file_name")
        ).withColumn("increment", F.lit(0)).repartition(1)
        before = bytes_below(folder)
        store.record(book.register_events(store.entries(contract, given), given, T1, store.sequence()))
        held = store.entries(contract, given)
        store.record(book.advance_events(held, given, ["archived", "staged"], T2, store.sequence()))
        after = bytes_below(folder)
        assert all(after[p] == size for p, size in before.items())  # nothing is rewritten
        return sum(after[p] for p in after.keys() - before.keys())

    first = batch((0, 100))
    batch((100, 30_000))
    assert batch((30_000, 30_100)) < 1.3 * first
    assert store.ledger(contract).where("date_staged IS NOT NULL").count() == 30_100
    want = rows(store.ledger(contract))
    store.compact(contract)
    assert rows(store.ledger(contract)) == want and store.events().count() <= 2 * 30_100


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(["k,v", *[f"{k},{v}" for k, v in lines]]) + "\n")


def test_merge_insert_appends(spark, fresh):
    folder, name = fresh
    store = Store(spark, folder + "/store", f"{name}_l.import_file")
    contract = contract_of(name, strategy="merge_insert")
    write(folder + "/1", "a.csv", [(1, "a"), (2, "b"), ("", "n")])
    write(folder + "/2", "b.csv", [(2, "B"), (3, "c"), (3, "d"), ("", "n")])
    ingest_batch(store, contract, folder + "/1", "b1", T1)
    old = bytes_below(store.table_root(contract))
    ingest_batch(store, contract, folder + "/2", "b2", T2)
    new = bytes_below(store.table_root(contract))
    assert old and all(new[p] == size for p, size in old.items())
    want = [(1, "a"), (2, "b"), (3, "c"), (3, "d"), (None, "n"), (None, "n")]
    assert rows(store.table(contract).select("k", "v")) == sorted(want, key=repr)


def test_new_rows_do_not_count_an_earlier_try(spark, fresh):
    """A load that was cut off after some of its rows were visible adds all of them when repeated, once."""
    from tidegate.sources import tables

    folder, name = fresh
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    tables.create(spark, f"{name}.t", schema, folder, [tables.LOAD])
    tables.append(spark, f"{name}.t", spark.createDataFrame([(1, "a")], schema), load="one")
    batch = spark.createDataFrame([(1, "x"), (2, "b"), (None, "n")], schema)
    tables.append(spark, f"{name}.t", batch.where("k = 2"), load="two")  # what a first try has left
    for _ in range(2):
        held = tables.others(spark, f"{name}.t", "two")
        tables.append(spark, f"{name}.t", new_rows(held, batch, "k"), load="two")
        assert rows(tables.read(spark, f"{name}.t")) == sorted([(1, "a"), (2, "b"), (None, "n")], key=repr)


@pytest.mark.parametrize("strategy", ["merge_update", "merge_date_rows"])
@pytest.mark.parametrize("keys", [["k"], ["k", "p"]])
def test_outer_join_equals_the_other_plan(spark, monkeypatch, strategy, keys):
    monkeypatch.setattr(merging, "SPREAD", 5)
    chance = random.Random(4)
    schema = "k int, p string, v string, _date_row_inserted int, _date_row_updated int"
    held = [(7, "a", "hot", 1, None)] * 400 + [(None, "a", "none", 1, None)] * 200
    held += [(chance.choice([i, i, None]), chance.choice("ab"), chance.choice(["x", None]), 1, None) for i in range(300)]
    target = spark.createDataFrame(held, schema)
    batch = {(k, p): (k, p, chance.choice(["x", "y", None]), 2, 2) for k in [7, *range(0, 500, 3)] for p in "ab"}
    if keys == ["k"]:
        batch = {k: row for (k, _), row in batch.items()}
    offered = spark.createDataFrame([*batch.values(), (None, "a", "q", 2, 2)], schema)
    other = merge(target, offered, keys, strategy, unique=True, change_column="c")
    outer = merge(target, offered, keys, strategy, unique=True, large=True, change_column="c")
    assert rows(outer) == rows(other)
    assert {r.c for r in outer.collect()} == {"keep", "unchanged", "update", "insert"}
    latest = merge(target, offered.union(offered.where("k IS NOT NULL")), keys, strategy, on_duplicate="latest", order_by=["v"], large=True)
    assert rows(latest) == rows(outer.drop("c"))
    assert heavy_hitters(target, key_mark(target, ["k"]))[0] == 7


def test_sizes(spark):
    assert not outgrows_broadcast(spark.range(1000)) and outgrows_broadcast(spark.range(10_000_000))
