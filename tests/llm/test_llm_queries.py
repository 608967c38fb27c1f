"""Registered corpus queries on the given tables: those with SQL against it, the others for their shape."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from agoralake.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_corpus_query(spark, name):
    ok, note = oracle.compare(spark, oracle.duck(SF_DIR), name, SF_DIR, QUERIES[name], ORACLES.get(name))
    assert ok, note


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in names if k.startswith("op") and k[2].isdigit()}
    assert "pipeline" in names


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert 0 < docs.count() <= 2 * n
        if i < 4:
            assert docs.columns == columns
    assert {"shard", "virtual_slot"} <= set(docs.columns)
