import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.functions import names
from tidegate.functions.compare import data_columns

# Raw (database, table) pairs and the qualified name they give.
QUALIFIED = [
    ("SoUrCe", "TaBle", "SoUrCe.TaBle"),
    ("So,UrCe", "Ta;Ble", "SoUrCe.TaBle"),
    (" source 1\t", "\ntable 2 ", "source_1.table_2"),
    ("source 1", "table 2", "source_1.table_2"),
    ("source-1", "table 2", "source_1.table_2"),
    ("source=1", "ta\nble\t2", "source_1.table_2"),
    ("source{1]", "table[2}", "source[1].table[2]"),
    ("source{1)", "table(2}", "source[1].table[2]"),
]


def test_qualified_names(spark):
    frame = spark.createDataFrame(QUALIFIED, "d string, t string, want string")
    wrong = frame.where(names.qualified_name("d", "t") != F.col("want"))
    assert wrong.count() == 0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" {}()\t=,;\nab-_[]  \x1c\x0b\r.é"), max_size=12), min_size=1, max_size=40))
def test_label_and_column_agree(spark, raw):
    frame = spark.createDataFrame([(r, names.clean_label(r), names.clean_major_label(r)) for r in raw], "r string, a string, b string")
    wrong = frame.where((names.clean_name("r") != F.col("a")) | (names.clean_major_name("r") != F.col("b")))
    assert wrong.count() == 0


def test_no_forbidden_character_is_left():
    cleaned = names.clean_label(" a {b}(c)\td=e,f;g\nh ")
    assert cleaned == "a_[b][c]_d-efgh"


def test_key_lists():
    assert names.key_list("col1, col{2}, col 4") == ["col1", "col[2]", "col_4"]
    assert names.key_list(["col1", " col 4 "]) == ["col1", "col_4"]
    assert names.key_list("") == []


def test_change_columns_leave_out_keys_and_engine_columns():
    columns = [names.clean_label(c) for c in ("col1", "col{2}", "col3", "col 4", "col 5", "_col_6")]
    assert data_columns(columns, names.key_list("col1, col{2}, col_4")) == ["col3", "col_5"]


@pytest.mark.parametrize(
    ("file_hash", "increment", "want"),
    [
        (123465789, 0, "table_name_123465789"),
        (123465789, 1, "table_name_123465789_1"),
        (-123465789, 0, "table_name_m123465789"),
        (-123465789, 2, "table_name_m123465789_2"),
    ],
)
def test_staged_identity(spark, file_hash, increment, want):
    frame = spark.createDataFrame([("table_name", file_hash, increment)], "t string, h int, i int")
    assert frame.select(names.staged_id("t", "h", "i")).first()[0] == want
    assert frame.select(names.staged_id("t", "h", increment)).first()[0] == want


def test_review_identity_is_the_next_attempt(spark):
    frame = spark.createDataFrame([("t", 5, 0), ("t", 5, 1)], "t string, h int, i int")
    assert [r[0] for r in frame.select(names.review_id("t", "h", "i")).collect()] == ["t_5_1", "t_5_2"]


def test_node_ids(spark):
    frame = spark.createDataFrame([("source",), ("model",)], "k string")
    ids = frame.select(names.node_id("k", F.lit("package_1"), F.lit("schema_1"), F.lit("name_1"))).collect()
    assert [r[0] for r in ids] == ["source.package_1.schema_1.name_1", "model.package_1.name_1"]
    with pytest.raises(Exception, match="unknown node kind"):
        spark.createDataFrame([("seed",)], "k string").select(
            names.node_id("k", F.lit("p"), F.lit("s"), F.lit("t"))
        ).collect()
