import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegate.operators.dedup import from_one_file, latest_per_key
from tidegate.operators.dml import delete_matching, delete_where, matching, update_from, update_where
from tidegate.operators.merge import load, merge
from pyspark.sql import functions as F

SCHEMA = "k int, v string, _load int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30), (None, "n", 0)], SCHEMA)


def test_merge_update(spark, target):
    incoming = spark.createDataFrame([(2, "B", 1), (3, None, 1), (4, "d", 1), (None, "x", 1)], SCHEMA)
    state = merge(target, incoming, "k", "merge_update", change_column="c")
    assert rows(state) == rows(
        spark.createDataFrame(
            [
                (1, "a", 10, "keep"),
                (2, "B", 1, "update"),
                (3, None, 30, "unchanged"),
                (None, "n", 0, "keep"),
                (4, "d", 1, "insert"),
                (None, "x", 1, "insert"),
            ],
            SCHEMA + ", c string",
        )
    )


def test_value_to_null_and_back_is_a_change(spark, target):
    incoming = spark.createDataFrame([(2, None, 1), (3, "c", 1)], SCHEMA)
    state = merge(target, incoming, ["k"], "merge_update")
    assert (2, None, 1) in rows(state) and (3, "c", 1) in rows(state)


def test_merge_insert_leaves_matched_rows(spark, target):
    incoming = spark.createDataFrame([(2, "B", 1), (4, "d", 1), (4, "e", 1)], SCHEMA)
    state = rows(merge(target, incoming, "k", "merge_insert"))
    assert (2, "b", 20) in state and (4, "d", 1) in state and (4, "e", 1) in state and len(state) == 6


def test_merge_date_rows(spark):
    schema = "k int, v string, _date_row_inserted int, _date_row_updated int"
    target = spark.createDataFrame([(1, "a", 5, None), (2, "b", 5, None)], schema)
    incoming = spark.createDataFrame([(2, "B", 9, 9), (1, "a", 9, 9), (3, "c", 9, 9)], schema)
    assert rows(merge(target, incoming, "k", "merge_date_rows")) == [(1, "a", 5, None), (2, "B", 5, 9), (3, "c", 9, None)]


def test_incoming_with_fewer_columns(spark, target):
    incoming = spark.createDataFrame([("4",), ("2",)], "K string")
    state = rows(merge(target, incoming, "k", "merge_update"))
    assert (4, None, None) in state and (2, "b", 20) in state


def test_only_keys_never_update(spark):
    target = spark.createDataFrame([(1, 7)], "k int, _load int")
    incoming = spark.createDataFrame([(1, 8)], "k int, _load int")
    assert rows(merge(target, incoming, "k", "merge_update")) == [(1, 7)]


def test_present_columns_keep_the_others(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    incoming = spark.createDataFrame(
        [(1, None, "X", ["k", "w"]), (2, "B", None, ["k", "v", "w"])], "k int, v string, w string, p array<string>"
    )
    assert rows(merge(target, incoming, "k", "merge_update", present="p")) == [(1, "a", "X"), (2, "B", None)]


def test_duplicates(spark, target):
    twice = spark.createDataFrame([(2, "B", 1), (2, "C", 2), (5, "e", 1), (5, "f", 2)], SCHEMA)
    with pytest.raises(Exception, match="several incoming rows match"):
        merge(target, twice, "k", "merge_update").collect()
    with pytest.raises(Exception, match="several incoming rows share"):
        merge(target, twice.where("k = 5"), "k", "merge_update", on_duplicate="error").collect()
    new_twice = rows(merge(target, twice.where("k = 5"), "k", "merge_update"))
    assert (5, "e", 1) in new_twice and (5, "f", 2) in new_twice
    ordered = twice.withColumn("at", F.col("_load"))
    last = rows(merge(target, ordered, "k", "merge_update", on_duplicate="latest", order_by=["at"]))
    assert (2, "C", 2) in last and (5, "f", 2) in last and len(last) == 5
    first = rows(merge(target, ordered, "k", "merge_update", on_duplicate="first", order_by=["at"]))
    assert (2, "B", 1) in first and (5, "e", 1) in first


def test_a_key_repeated_in_the_table_updates_all_its_rows(spark):
    target = spark.createDataFrame([(1, "a", 0), (1, "b", 0), (2, "c", 0)], SCHEMA)
    incoming = spark.createDataFrame([(1, "z", 1)], SCHEMA)
    assert rows(merge(target, incoming, "k", "merge_update")) == [(1, "z", 1), (1, "z", 1), (2, "c", 0)]


def test_refusals(spark, target):
    incoming = spark.createDataFrame([(1, "a", 0)], SCHEMA)
    with pytest.raises(ValueError, match="no merge strategy"):
        merge(target, incoming, "k", "insert")
    with pytest.raises(ValueError, match="not in the table"):
        merge(target, incoming.withColumn("extra", F.lit(1)), "k", "merge_update")
    with pytest.raises(ValueError, match="key columns"):
        merge(target, incoming, "j", "merge_update")
    with pytest.raises(ValueError, match="unknown strategy"):
        load(target, incoming, "upsert")
    with pytest.raises(ValueError, match="duplicate policy"):
        merge(target, incoming, "k", "merge_update", on_duplicate="some")


def test_load_without_keys(spark, target):
    incoming = spark.createDataFrame([(1, "a", 10), (9, "z", 1)], SCHEMA)
    assert len(rows(load(target, incoming, "insert"))) == 6
    assert rows(load(target, incoming, "replace")) == [(1, "a", 10), (9, "z", 1)]
    assert rows(load(target, incoming.limit(0), "replace")) == rows(target)
    assert rows(load(target, incoming.limit(0), "insert")) == rows(target)


def _by_hand(target, incoming, strategy):
    keys_held = {r[0] for r in target if r[0] is not None}
    offered = {r[0]: r for r in incoming if r[0] is not None}
    result = []
    for row in target:
        new = offered.get(row[0])
        if strategy == "merge_update" and new is not None and new[1] != row[1]:
            row = new
        result.append(row)
    return sorted(result + [r for r in incoming if r[0] not in keys_held], key=repr)


KEY = st.one_of(st.none(), st.integers(0, 6))
VALUE = st.one_of(st.none(), st.sampled_from("abc"))


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.tuples(KEY, VALUE), max_size=12),
    st.lists(st.tuples(KEY, VALUE), max_size=8, unique_by=lambda r: object() if r[0] is None else r[0]),
)
def test_merges_against_brute_force(spark, held, given_rows):
    target = [(k, v, 0) for k, v in held]
    incoming = [(k, v, 1) for k, v in given_rows]
    t, i = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(incoming, SCHEMA)
    for strategy in ("merge_update", "merge_insert"):
        assert rows(merge(t, i, "k", strategy)) == _by_hand(target, incoming, strategy)
    labelled = merge(t, i, "k", "merge_insert", change_column="c").drop("c")
    assert rows(labelled) == _by_hand(target, incoming, "merge_insert")


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(0, 6), VALUE, max_size=6), st.dictionaries(st.integers(0, 6), VALUE, max_size=6))
def test_merging_twice_is_merging_once(spark, held, offered):
    t = spark.createDataFrame([(k, v, 0) for k, v in held.items()], SCHEMA)
    i = spark.createDataFrame([(k, v, 1) for k, v in offered.items()], SCHEMA)
    once = merge(t, i, "k", "merge_update")
    assert rows(merge(once, i, "k", "merge_update")) == rows(once)
    inserted = {r[0] for r in rows(merge(t, i, "k", "merge_insert"))}
    assert inserted == {r[0] for r in rows(once)}


def test_latest_per_key(spark):
    frame = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (None, "d", 1), (None, "e", 2)], "k int, v string, t int")
    assert rows(latest_per_key(frame, ["k"], ["t"])) == [(1, "b", 3), (None, "e", 2)]


def test_rows_of_the_last_file_only(spark):
    frame = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (1, "c", 2), (2, "d", 1), (None, "e", 1), (None, "f", 2)], "k int, v string, f int"
    )
    assert rows(from_one_file(frame, ["k"], ["f"], "latest")) == [
        (1, "b", 2), (1, "c", 2), (2, "d", 1), (None, "e", 1), (None, "f", 2),
    ]
    assert (1, "a", 1) in rows(from_one_file(frame, ["k"], ["f"], "first"))


def test_updates_and_deletes(spark, target):
    changed = update_where(target, F.col("k") > 1, {"v": F.concat("v", F.lit("!")), "_load": F.col("k")})
    assert rows(changed) == rows(spark.createDataFrame([(1, "a", 10), (2, "b!", 2), (3, None, 3), (None, "n", 0)], SCHEMA))
    batch = spark.createDataFrame([(2, "u"), (3, None)], "k int, v string")
    assert rows(update_from(target, batch, "k")) == rows(
        spark.createDataFrame([(1, "a", 10), (2, "u", 20), (3, None, 30), (None, "n", 0)], SCHEMA)
    )
    assert [r[0] for r in rows(delete_where(target, F.col("k") > 1))] == [1, None]
    doomed = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert {r[0] for r in rows(delete_matching(target, doomed, "k"))} == {1, 3, None}
    assert rows(matching(target, doomed, "k")) == [(2, "b", 20)]
