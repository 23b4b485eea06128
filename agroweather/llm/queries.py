"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroweather.llm import (
    bpe,
    decontaminate,
    embedding_join,
    hard_negatives,
    inner_products,
    langid,
    license_scan,
    line_dedup,
    ngram_join,
    periodic_runs,
    quality,
    secrets,
    url_filter,
)
from agroweather.llm.common import table

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed public vocabulary lies; the same place on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_language(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, vocabulary_path(), with_ids=False)


def op4_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.link_embeddings(table(spark, sf_dir, "embeddings"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages"))
    return judged.withColumn("purity", F.round("purity", 9))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_negatives(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(periodic_runs.plant_runs(table(spark, sf_dir, "documents")))


def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.top_products(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_language_id": op2_language_id,
    "op3_bpe": op3_bpe,
    "op4_embedding_join": op4_embedding_join,
    "op5_ngram_join": op5_ngram_join,
    "op6_license_scan": op6_license_scan,
    "op7_quality": op7_quality,
    "op8_url_filter": op8_url_filter,
    "op9_decontamination": op9_decontamination,
    "op10_secrets": op10_secrets,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_top_products": op13_top_products,
}
