"""County reference files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agroweather.schemas import COUNTY_CENTROIDS


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-delimited gazetteer: every field is text, header names lose their padding."""
    raw = (
        spark.read.option("sep", "|")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return raw.toDF(*[name.strip() for name in raw.columns]).na.fill("")


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Centroid seed. The key stays text so leading zeros survive; a bad number fails the read."""
    return (
        spark.read.schema(COUNTY_CENTROIDS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
