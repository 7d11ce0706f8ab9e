"""The registered queries against their SQL, and the pipeline's stages one by one."""

import os

import pytest
from oracle import compare

import __spark_entry__ as entry
import corpus_pipeline
from tidegate.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_all_queries_are_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, SF, QUERIES[name], SQL[name]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.join(docs, "doc_id", "left_anti").count() == 0
        docs = spark.createDataFrame(out.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in docs.collect())
    assert all(len(r.ids) == r.n_tokens for r in last)
    whole = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in last) == sorted(tuple(r) for r in whole)
