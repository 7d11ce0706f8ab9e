from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidegate.operators import ledger as book

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def files(spark, *names, increment=0):
    return spark.createDataFrame(
        [("s", "t", n, increment) for n in names], "source string, table string, file_name string, increment int"
    )


@pytest.fixture
def ledger(spark):
    return book.register(book.empty(spark), files(spark, "a.csv", "b.csv"), T1).ledger


def test_register(spark, ledger):
    assert ledger.columns == book.SCHEMA.fieldNames()
    assert [f.dataType for f in ledger.schema.fields] == [f.dataType for f in book.SCHEMA.fields]
    row = ledger.where("file_name = 'a.csv'").first()
    assert (row.increment, row.date_new, row.date_archived, row._date_row_inserted, row._date_row_updated) == (0, T1, None, T1, None)
    assert row.hash == spark.range(1).select(F.hash(F.lit("s"), F.lit("t"), F.lit("a.csv"))).first()[0]
    again = book.register(ledger, files(spark, "a.csv", "a.csv", "c.csv"), T2)
    assert [(r[3], r[6]) for r in rows(again.ledger.select("*"))] and again.ledger.count() == 3
    assert again.ledger.where("file_name = 'a.csv'").first().date_new == T1
    assert again.rejected.count() == 0


def test_an_attempt_needs_the_one_before(spark, ledger):
    result = book.register(ledger, files(spark, "a.csv", "z.csv", increment=1).union(files(spark, "b.csv", increment=2)), T2, ["archived", "staged"])
    added = result.ledger.where("increment > 0").collect()
    assert [(r.file_name, r.increment, r.date_staged, r.date_cleaned) for r in added] == [("a.csv", 1, T2, None)]
    assert rows(result.rejected) == [("s", "t", "b.csv", 2), ("s", "t", "z.csv", 1)]


def test_lookup(spark, ledger):
    assert book.lookup(ledger, files(spark, "a.csv", "q.csv")).count() == 1
    assert rows(book.missing_entries(ledger, files(spark, "a.csv", "q.csv"))) == [("s", "t", "q.csv", 0)]


def test_stage_walk(spark, ledger):
    entry = files(spark, "a.csv")
    state = ledger
    for stage in ("new", "archived", "staged", "cleaned", "inserted", "completed"):
        state = book.advance(state, entry, stage, T2)
        assert book.with_stage(state).where("file_name = 'a.csv'").first().stage == stage
    assert book.with_stage(state).where("file_name = 'b.csv'").first().stage == "new"
    row = state.where("file_name = 'a.csv'").first()
    assert row.date_new == T1 and row.date_completed == T2 and row._date_row_updated == T2
    later = book.advance(state, entry, ["inserted", "completed"], datetime(2025, 1, 1))
    assert rows(later) == rows(state)


def test_counts_and_names(spark, ledger):
    staged = files(spark, "a.csv", "a.csv", "b.csv")
    state = book.set_rows_read(ledger, book.count_rows(staged), T2)
    assert {r.file_name: r.rows_read for r in state.collect()} == {"a.csv": 2, "b.csv": 1}
    named = book.set_processed_name(state, files(spark, "a.csv").withColumn("processed_file_name", F.lit("a2.csv")), T2)
    assert {r.file_name: r.processed_file_name for r in named.collect()} == {"a.csv": "a2.csv", "b.csv": None}


def test_resume(spark, ledger):
    state = book.advance(ledger, files(spark, "a.csv"), "inserted", T2)
    assert [r.file_name for r in book.unfinished(state, files(spark, "a.csv", "b.csv"), "inserted").collect()] == ["b.csv"]
    assert book.unfinished(state, files(spark, "a.csv", "b.csv"), "completed").count() == 2


def test_abandon(spark, ledger):
    state = book.advance(ledger, files(spark, "a.csv", "b.csv"), "staged", T1)
    state = book.register(state, files(spark, "b.csv", increment=1), T1, ["archived", "staged"]).ledger
    state = book.register(state, files(spark, "c.csv"), T1).ledger
    state = book.advance(state, files(spark, "a.csv"), "inserted", T1)
    staged = files(spark, "a.csv", "b.csv", "b.csv").union(files(spark, "b.csv", increment=1))

    one = book.abandon(state, staged, files(spark, "b.csv", increment=1))
    assert one.ledger.count() == 4 and one.staged.count() == 3 and one.refused.count() == 0

    result = book.abandon(state, staged, files(spark, "a.csv", "b.csv", "c.csv"))
    assert rows(result.refused) == [("s", "t", "a.csv", 0, "inserted")]
    assert rows(result.ledger.select("file_name", "increment")) == [("a.csv", 0)]
    assert rows(result.staged) == [("s", "t", "a.csv", 0), ("s", "t", "b.csv", 1)]


def test_status_view(spark, ledger):
    state = book.advance(ledger, files(spark, "a.csv"), ["archived", "completed"], T2)
    state = book.register(state, files(spark, "a.csv", increment=1), T2).ledger
    found = {t: [(r.file_name, r.increment) for r in book.status_view(state, t).collect()] for t in book.ENTRY_TYPES}
    assert found["Complete"] == [("a.csv", 0)]
    assert found["Issues"] == [("a.csv", 1)]
    assert found["Incomplete"] == [("a.csv", 1), ("b.csv", 0)]
    assert len(found["All"]) == 3
    assert book.status_view(state, "All", source="other").count() == 0
    assert book.status_view(state, "All", source="s", table="t").count() == 3
    with pytest.raises(ValueError, match="unknown entry type"):
        book.status_view(state, "Broken")
    assert rows(book.facets(state, "file_name")) == [("a.csv",), ("b.csv",)]


def test_review_entries(spark):
    failing = files(spark, "a.csv").withColumn("rows_failed", F.lit(3).cast("long"))
    row = book.review_entries(failing, T2).first()
    assert (row.increment, row.rows_read, row.date_archived, row.date_staged, row.date_cleaned) == (1, 3, T2, T2, None)


def test_rename(spark, ledger):
    renamed = book.rename_table(ledger, "s", "t", "u")
    held = ledger.select(F.col("hash").alias("_hash"), F.lit(1).alias("x"))
    moved = book.rekey_rows(held.union(spark.createDataFrame([(5, 2)], "_hash int, x int")), renamed.mapping)
    want = spark.createDataFrame([("s", "u", "a.csv"), ("s", "u", "b.csv")], "a string, b string, c string")
    hashes = {r[0] for r in want.select(F.hash("a", "b", "c")).collect()}
    assert {r.hash for r in renamed.ledger.collect()} == hashes
    assert {r._hash for r in moved.collect()} == hashes | {5}
    assert {r.table for r in renamed.ledger.collect()} == {"u"}
