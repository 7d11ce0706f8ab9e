"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest
from oracle import compare

import __spark_entry__ as entry
from tidegate.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert compare(spark, SF, QUERIES[name], SQL[name]) is None


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_flagship(spark):
    frame = entry.entry(spark)
    assert {r._change for r in frame.select("_change").distinct().collect()} == {"keep", "update", "unchanged", "insert"}
