from datetime import datetime

import pytest
from helpers import rows

from tidegate.operators import history

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
SCHEMA = "k int, v string, _load int"


def test_versions(spark):
    first = history.begin(spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, None, 0)], SCHEMA), T1)
    second = history.snapshot(first, spark.createDataFrame([(1, "a", 1), (2, "B", 1), (4, "d", 1)], SCHEMA), "k", T2)
    assert rows(second) == rows(
        spark.createDataFrame(
            [
                (1, "a", 0, T1, None),
                (2, "b", 0, T1, T2),
                (2, "B", 1, T2, None),
                (3, None, 0, T1, None),
                (4, "d", 1, T2, None),
            ],
            SCHEMA + ", _valid_from timestamp, _valid_to timestamp",
        )
    )
    third = history.snapshot(second, spark.createDataFrame([(2, "b", 2), (3, "c", 2)], SCHEMA), "k", T3)
    assert [r[1:] for r in rows(third.where("k = 2"))] == [("B", 1, T2, T3), ("b", 0, T1, T2), ("b", 2, T3, None)]
    assert third.where("_valid_to IS NULL").count() == 4
    assert rows(history.snapshot(third, spark.createDataFrame([(2, "b", 9)], SCHEMA), "k", T3)) == rows(third)


def test_ambiguous_or_null_keys_fail(spark):
    first = history.begin(spark.createDataFrame([(1, "a", 0)], SCHEMA), T1)
    for bad in ([(1, "a", 1), (1, "b", 1)], [(None, "a", 1)]):
        with pytest.raises(Exception, match="unique and not NULL"):
            history.snapshot(first, spark.createDataFrame(bad, SCHEMA), "k", T2).collect()
