from decimal import Decimal

from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.parse import parse_text
from tidegate.operators import quality
from tidegate.operators.evolve import add_columns, align, drift, drift_report
from tidegate.operators.quality import Accepted, NotNull, References, Unique, Where

SCHEMA = "f string, k int, v string"


def test_every_rule(spark):
    frame = spark.createDataFrame(
        [("x", 1, "a"), ("x", 1, "z"), ("y", 1, "a"), ("y", None, None), ("y", 9, "b"), ("y", None, "a")], SCHEMA
    )
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    rules = [
        NotNull("v"),
        Unique("k"),
        Accepted("v", ("a", "b")),
        References("k", parent, "id"),
        Where("big", "k > 5"),
    ]
    for measured in (False, True):
        marked = quality.mark(frame, rules, scope=["f"], measured=measured)
        assert marked.columns == ["f", "k", "v", "_failed_rules"]
        assert {(r.f, r.k, r.v): r._failed_rules for r in marked.collect()} == {
            ("x", 1, "a"): ["unique(k)"],
            ("x", 1, "z"): ["unique(k)", "accepted_values(v)"],
            ("y", 1, "a"): [],
            ("y", None, None): ["not_null(v)"],
            ("y", 9, "b"): ["relationships(k)", "big"],
            ("y", None, "a"): [],
        }
    without_scope = quality.mark(frame, [Unique("k")])
    assert without_scope.where(F.size("_failed_rules") > 0).count() == 3


def test_split_verdict_and_failures(spark):
    frame = spark.createDataFrame([("x", 1, "a"), ("x", None, None), ("y", 2, "b")], SCHEMA)
    marked = quality.mark(frame, [NotNull("k"), NotNull("v")])
    assert rows(quality.clean_rows(marked)) == [("x", 1, "a"), ("y", 2, "b")]
    assert [r[:3] for r in rows(quality.review_rows(marked))] == [("x", None, None)]
    assert rows(quality.verdict(marked, ["f"])) == [("x", 2, 1, False), ("y", 1, 0, True)]
    assert rows(quality.failures(marked, ["f"])) == [("x", "not_null(k)", 1), ("x", "not_null(v)", 1)]


def test_no_rules_means_all_clean(spark):
    frame = spark.createDataFrame([("x", 1, "a")], SCHEMA)
    assert quality.clean_rows(quality.mark(frame, [])).count() == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("xy"), st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from("ab"))), max_size=15))
def test_clean_and_review_make_up_the_whole(spark, data):
    frame = spark.createDataFrame(data, SCHEMA)
    marked = quality.mark(frame, [NotNull("v"), Unique("k")], scope=["f"])
    both = quality.clean_rows(marked).unionByName(quality.review_rows(marked).drop("_failed_rules"))
    assert rows(both) == rows(frame)
    copies = {(f, k) for f, k, _ in data if k is not None and sum(1 for a, b, _ in data if (a, b) == (f, k)) > 1}
    bad = sorted([r for r in data if r[2] is None or (r[0], r[1]) in copies], key=repr)
    assert [r[:3] for r in rows(quality.review_rows(marked))] == bad


def test_requeue(spark):
    review = spark.createDataFrame(
        [(1, None, 0, ["not_null(v)"]), (2, None, 0, ["not_null(v)"])], "k int, v string, increment int, _failed_rules array<string>"
    )
    fixes = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(quality.requeue(review, fixes, "k")) == [(1, "a", 1), (2, None, 1)]


def test_unreadable_text_becomes_null(spark):
    schema = T.StructType.fromDDL("d date, n decimal(18,9), i int, t timestamp, b boolean")
    frame = spark.createDataFrame(
        [("2020-01-02", "1.5", "3", "2020-01-02 03:04:05", "True"), ("soon", "abc", "True", "6", "perhaps")],
        "d string, n string, i string, t string, b string",
    )
    good, bad = parse_text(frame, schema, "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss").collect()
    assert None not in good and list(bad) == [None] * 5


def test_drift_and_align(spark):
    have = T.StructType.fromDDL("DATE date, open decimal(18,9), close string, more int, _hash int")
    want = T.StructType.fromDDL("date date, open decimal(18,9), close decimal(18,9), volume int, isGood boolean")
    assert drift(have, want) == [
        ("close", "type", "string", "decimal(18,9)"),
        ("volume", "missing", None, "int"),
        ("isGood", "missing", None, "boolean"),
        ("more", "extra", "int", None),
    ]
    frame = spark.createDataFrame([(None, None, "1.25", 3, 4), (None, None, "x", 3, 4)], have)
    assert [r.close for r in align(frame, want).collect()] == [Decimal("1.25"), None]
    assert align(frame, want).schema.fieldNames() == want.fieldNames()
    assert add_columns(frame, want).columns == ["DATE", "open", "close", "more", "_hash", "volume", "isGood"]
    assert {r.table_rows for r in drift_report(frame, want).collect()} == {2}
    assert drift_report(frame, have).count() == 0
