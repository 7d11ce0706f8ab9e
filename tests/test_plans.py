"""What the physical plans must look like, and skewed keys at full strength."""

import contextlib
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidegate.operators import quality
from tidegate.operators.dedup import one_per_key
from tidegate.operators.history import begin, snapshot
from tidegate.operators.ledger import count_rows, rekey_rows
from tidegate.operators.merge import merge
from tidegate.operators.quality import Unique
from tidegate.operators.sizing import settle


@contextlib.contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
SMALL_SKEW = {
    **NO_BROADCAST,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
}


def plan_of(df):
    """The plan as it was run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def static_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two thirds distinct keys, one third of the rows under one key or under NULL."""
    folder = str(tmp_path_factory.mktemp("skew"))
    n = 30_000
    base = spark.range(0, n, 1, 16).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
    # Fixture keys, not a subset of rows: every third row shares a key.
    base.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("k"), "v").write.parquet(folder + "/hot")
    base.select(F.when(F.col("id") % 3 != 0, F.col("id") + 10).alias("k"), "v").write.parquet(folder + "/nulls")
    base.select((F.col("id") + 7).alias("k"), F.lit("new").alias("v")).write.parquet(folder + "/incoming")
    spark.range(5).select((F.col("id") + 7).alias("k"), F.lit("new").alias("v")).write.parquet(folder + "/small")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in ("hot", "nulls", "incoming", "small")}


def test_a_small_batch_never_shuffles_the_table(tables):
    plan = static_plan(merge(tables["hot"], tables["small"], "k", "merge_update"))
    assert "SortMergeJoin" not in plan
    # The exchanges left: two of the batch, and the table's keys after the semi join.
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("BroadcastHashJoin") == 3
    keys_found = plan.split("LeftAnti")[1]
    assert keys_found.index("Exchange hashpartitioning") < keys_found.index("LeftSemi")
    plan = static_plan(merge(tables["hot"], tables["small"], "k", "merge_insert"))
    assert "SortMergeJoin" not in plan and "ReadSchema: struct<k:bigint>" in plan


@pytest.mark.parametrize("name", ["hot", "nulls"])
def test_hot_keys_are_split_and_nothing_is_lost(spark, tables, name):
    target, incoming = tables[name], tables["incoming"]
    with conf(spark, **SMALL_SKEW):
        state = merge(target, incoming, "k", "merge_update")
        assert "skew=true" in plan_of(state).replace("isSkew", "skew")
        found = Counter(tuple(r) for r in state.collect())
    offered = {r.k for r in incoming.collect()}
    held = [tuple(r) for r in target.collect()]
    want = Counter((k, "new" if k in offered else v) for k, v in held)
    want.update((k, "new") for k in offered - {k for k, _ in held})
    assert found == want


def test_hot_duplicates_are_marked_without_a_window(spark, tables):
    with conf(spark, **SMALL_SKEW):
        marked = quality.mark(tables["hot"], [Unique("k")])
        plan = plan_of(marked)
        assert "Window" not in plan and "skew=true" in plan.replace("isSkew", "skew")
        assert marked.where(F.size("_failed_rules") > 0).count() == 10_000
    # Few duplicate values, measured: the rows themselves are not shuffled.
    measured = quality.mark(tables["hot"], [Unique("k")], measured=True)
    plan = static_plan(measured)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert measured.where(F.size("_failed_rules") > 0).count() == 10_000


def test_one_per_key_merges_partial_results_first(tables):
    plan = static_plan(one_per_key(tables["hot"], ["k"], "latest", ["v"]))
    assert "partial_max_by" in plan and "Window" not in plan
    assert one_per_key(tables["hot"], ["k"], "latest", ["v"]).count() == 20_001


def test_history_passes_closed_rows_by(spark, tables):
    history = begin(tables["small"], F.lit("2024-01-01").cast("timestamp"))
    plan = static_plan(snapshot(history, tables["small"], "k", F.lit("2024-02-01").cast("timestamp")))
    assert "SortMergeJoin" not in plan


def test_rekey_and_counts_over_a_hot_file(spark, tables):
    mapping = spark.createDataFrame([(7, -7)], "hash bigint, new_hash bigint")
    moved = rekey_rows(tables["hot"].withColumnRenamed("k", "_hash"), mapping)
    assert moved.where("_hash = -7").count() == 10_000 and moved.count() == 30_000
    staged = tables["hot"].select(
        F.lit("s").alias("source"), F.lit("t").alias("table"), F.col("k").cast("string").alias("file_name"), F.lit(0).alias("increment")
    )
    assert "partial_count" in static_plan(count_rows(staged))
    assert count_rows(staged).where("file_name = '7'").first().rows_read == 10_000


def test_settle_hints_only_within_the_bound(spark):
    frame = spark.range(1000).withColumn("t", F.lit("x" * 10))
    small, large = settle(frame), settle(frame, bound=1000)
    assert small.rows == large.rows == 1000
    assert rows(small.frame) == rows(large.frame)
    target = spark.range(10)
    with conf(spark, **NO_BROADCAST):
        assert "BroadcastHashJoin" in static_plan(target.join(small.frame, "id", "left_semi"))
        assert "BroadcastHashJoin" not in static_plan(target.join(large.frame, "id", "left_semi"))
