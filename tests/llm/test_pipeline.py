"""The pipeline's stages and the registered text queries."""

import os

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from agroweather.llm import quality
from tests.llm.conftest import CASES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def sf_dir(spark, labels, docs, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark = spark.createDataFrame([(1, " ".join(CASES[0][1].split()[12:26]))], "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_hand_on_documents(spark, docs, sf_dir):
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, sf_dir)
        assert frame.columns == docs.columns, name
        assert [f.dataType for f in frame.schema] == [f.dataType for f in docs.schema], name
    assert {"doc_id", "ids", "n_tokens"} <= set(corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).columns)


def test_decisions_take_effect(spark, docs, sf_dir, monkeypatch):
    monkeypatch.setattr(quality, "trained", lambda *_, **__: 0.9)
    kept = {row.doc_id: row for row in corpus_pipeline.run(spark, sf_dir).collect()}
    assert kept.keys() == {1, 2, 3, 6, 7, 8, 10, 11, 12, 13, 14, None}
    monkeypatch.setattr(quality, "trained", lambda *_, **__: 0.1)
    assert corpus_pipeline.run(spark, sf_dir).count() == 0


def test_empty_documents(spark, nothing, sf_dir):
    frame = nothing
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf_dir)
    assert frame.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_registered(spark):
    names = [name for name in queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 11))
    assert "pipeline" in queries() and "op1_line_dedup" in oracle_sql()
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert queries()["op10_secrets"](spark, SF_DIR).count() == documents
