"""What executors need and what extra columns may be called."""

import os
import subprocess
import sys

import pytest

from agroweather.llm import common, decontaminate, line_dedup, ngram_join, quality

HELPERS = ["__gone", "__doc", "__LINES", "__kept", "__keep", "__body", "__spans", "__Items", "__quality", "__quality_"]


@pytest.fixture(scope="module")
def crowded(docs):
    for name in HELPERS:
        docs = docs.withColumn(name, docs["doc_id"].cast("string"))
    return docs


@pytest.mark.parametrize("stage", ["quality", "lines", "copies", "benchmark"])
def test_columns_named_like_helpers_stay(spark, docs, crowded, labels, stage):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    run = {
        "quality": lambda df: quality.keep_quality(df, labels),
        "lines": line_dedup.dedup_lines,
        "copies": ngram_join.keep_representatives,
        "benchmark": lambda df: decontaminate.decontaminate(df, benchmark),
    }[stage]
    got = run(crowded)
    assert got.columns == crowded.columns
    rows = got.collect()
    assert all(row[name] == (None if row.doc_id is None else str(row.doc_id)) for row in rows for name in HELPERS)
    plain = run(docs).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in rows) == sorted((str(r.doc_id), r.text or "") for r in plain)


def test_free_name():
    assert common.free_name(["a", "A_", "b"], "a") == "a__"
    assert common.free_name([], "a") == "a"


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from agroweather.llm import decontaminate, hard_negatives, inner_products, periodic_runs, quality
from agroweather.session import build_session

spark = build_session("apart", master="local[2]", initial_partitions=2, extra={{"spark.ui.enabled": "false"}})
docs = spark.createDataFrame([(i, "some words of text " * (i % 9)) for i in range(60)], "doc_id long, text string")
labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")
items = docs.where("doc_id = 4").selectExpr("doc_id AS item_id", "text")
print(quality.classify_quality(docs, labels).count())
print(decontaminate.contamination_report(docs, items).where("contaminated").count())
print(periodic_runs.run_report(docs).where("n_runs > 0").count())
vectors = spark.createDataFrame([(i, i % 3, [1.0, i / 7]) for i in range(200)], "vec_id long, label int, embedding array<double>")
print(inner_products.top_products(vectors).count(), hard_negatives.mine_negatives(vectors).count() > 0)
"""


def test_workers_need_no_copy_of_the_library(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert done.stdout.split() == ["60", "39", "18", "20", "True"], done.stderr[-2000:]
