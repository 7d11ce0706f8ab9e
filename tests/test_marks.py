from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegate.functions import marks


@pytest.mark.parametrize(
    ("parts", "want"),
    # File identities that loaded tables already carry.
    [(("test_data", "table1", "file1.csv"), 1767481205), (("test_data", "table0", "file0.csv"), 959402806)],
)
def test_file_hash(spark, parts, want):
    frame = spark.createDataFrame([parts], "s string, t string, f string")
    assert frame.select(marks.file_hash("s", "t", "f")).first()[0] == want


def test_stages_are_ordered(spark):
    ranked = spark.createDataFrame([(s,) for s in marks.STAGES], "s string").select("s", marks.stage_rank(F.col("s")).alias("r"))
    assert [r.r for r in sorted(ranked.collect(), key=lambda r: r.r)] == [1, 2, 3, 4, 5, 6]
    assert spark.range(1).select(marks.stage_rank("new") < marks.stage_rank("completed")).first()[0]
    assert spark.range(1).select(marks.stage_rank("staged") >= marks.stage_rank("staged")).first()[0]


def test_unknown_stage_is_refused(spark):
    with pytest.raises(ValueError, match="unknown stage"):
        marks.stamp_column("tested")
    with pytest.raises(ValueError, match="unknown stage"):
        marks.stage_rank("tested")
    assert spark.range(1).select(marks.stage_rank(F.lit("tested"))).first()[0] is None


def test_current_stage_is_the_last_stamp(spark):
    columns = ", ".join(f"{marks.stamp_column(s)} timestamp" for s in marks.STAGES)
    t = datetime(2024, 1, 1)
    data = [(t, None, None, None, None, None), (t, t, t, None, None, None), (t, t, t, t, t, t), (t, None, t, None, None, None)]
    found = [r[0] for r in spark.createDataFrame(data, columns).select(marks.current_stage()).collect()]
    assert found == ["new", "staged", "completed", "staged"]
    reached = [r[0] for r in spark.createDataFrame(data, columns).select(marks.reached("staged")).collect()]
    assert reached == [False, True, True, True]
