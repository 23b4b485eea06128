"""From raw documents to token ids: the corpus pipeline of five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on what its predecessor kept:

1. quality: documents that the classifier rejects go;
2. lines: lines that three or more documents share stay in the last of them only;
3. copies: of each group of linked documents the one with the smallest id stays;
4. benchmark: benchmark passages are cut out, mostly contaminated documents go;
5. tokens: the texts as token ids.

All but the last return the columns of ``documents``. Rows with NULL texts are
empty texts; the operators' docstrings define the other cases. The classifier's
scores are no SQL, so ``ORACLE_SQL`` is None; tests hold each stage to brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroweather.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from agroweather.llm.common import stored, table
from agroweather.llm.queries import vocabulary_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_representatives(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
    )


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, vocabulary_path())


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("copies", copy_stage),
    ("benchmark", benchmark_stage),
    ("tokens", token_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last stored for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
