"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
import sql_check
from millrace.llm.queries import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    ok, note = sql_check.compare(spark, sf_dir, name)
    assert ok, note


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf_dir)
        assert after.columns == docs.columns, name
        assert {r["doc_id"] for r in after.collect()} <= {r["doc_id"] for r in kept.collect()}
        kept = spark.createDataFrame(after.collect(), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert packed.select("doc_id").distinct().count() == kept.count()
