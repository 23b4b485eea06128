"""Small questions asked of a table before a load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroweather.operators.publish import recover
from agroweather.schemas import RAW_YIELD
from agroweather.sources.lake import table_or_none

def year_probe(raw_yields: DataFrame, year: int) -> DataFrame:
    """One row ``(year, loaded)``; stops at the first row of that year's partition."""
    hit = raw_yields.filter(F.col("year") == F.lit(int(year))).select(F.lit(1)).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("loaded")).select(
        F.lit(int(year)).cast("bigint").alias("year"), "loaded"
    )


def year_is_loaded(spark: SparkSession, raw_path: str, year: int) -> bool:
    """Does the raw yield table hold the year? A table without a finished write holds none.

    A load that was cut off after its gate counts: it is put in place first.
    """
    recover(spark, raw_path)
    raw = table_or_none(spark, raw_path, RAW_YIELD)
    return raw is not None and year_probe(raw, year).head().loaded


def listed_files(
    spark: SparkSession, path: str, column: str = "date", kind: str | None = "date"
) -> DataFrame:
    """``(path, length, modificationTime, <column>)`` of every file below partition folders.

    No file is opened. A table without files has no folder level, hence no rows.
    ``kind`` is the type of the column; None leaves the inferred one.
    """
    listing = spark.read.format("binaryFile").load(path)
    if column not in listing.columns:
        listing = listing.limit(0).withColumn(column, F.lit(None).cast(kind or "string"))
    value = F.col(column).cast(kind) if kind else F.col(column)
    return listing.select("path", "length", "modificationTime", value.alias(column))


def high_watermark(spark: SparkSession, path: str, column: str = "date") -> date | None:
    """Greatest value of a date partition column, or None for an empty table."""
    return listed_files(spark, path, column).agg(F.max(column).alias("value")).head().value
