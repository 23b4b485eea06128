"""Freshness of the raw tables, told from the logs of their loads: no row is read."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroweather.operators.publish import recover
from agroweather.plans.ingestion import WEATHER_TABLE, YIELD_TABLE
from agroweather.sources.lake import Lake, table_or_none

LOAD_LOG = "n_rows long, latest timestamp"


class StaleSource(RuntimeError):
    """A raw table is older than its limit, or was never loaded."""


@dataclass(frozen=True)
class AgeLimits:
    """Ages of the greatest load stamp beyond which a source is warned of, or fails."""

    warn: timedelta
    error: timedelta


SOURCES = {
    WEATHER_TABLE: AgeLimits(timedelta(days=2), timedelta(days=7)),
    YIELD_TABLE: AgeLimits(timedelta(days=370), timedelta(days=400)),
}


def source_freshness(
    spark: SparkSession, lake: Lake, now: datetime, limits: dict[str, AgeLimits] | None = None
) -> DataFrame:
    """``(source, latest, n_loads, age_seconds, status)``, one row per source.

    The status is ``pass``, ``warn`` or ``error`` by the age of the greatest stamp that a
    finished load of the table noted; a source without a load is an error.
    """

    def row(source: str, limit: AgeLimits) -> DataFrame:
        path = lake.loads(source)
        recover(spark, path)
        log = table_or_none(spark, path, LOAD_LOG)
        if log is None:
            log = spark.createDataFrame([], LOAD_LOG)
        age = F.unix_timestamp(F.lit(now)) - F.unix_timestamp("latest")
        return (
            log.agg(F.max("latest").alias("latest"), F.count(F.lit(1)).alias("n_loads"))
            .withColumn("age_seconds", age)
            .select(
                F.lit(source).alias("source"),
                "latest",
                "n_loads",
                "age_seconds",
                F.when(F.col("age_seconds") <= int(limit.warn.total_seconds()), "pass")
                .when(F.col("age_seconds") <= int(limit.error.total_seconds()), "warn")
                .otherwise("error")
                .alias("status"),
            )
        )

    rows = [row(source, limit) for source, limit in (SOURCES if limits is None else limits).items()]
    return reduce(DataFrame.unionByName, rows)


def enforce_freshness(results: DataFrame) -> list[str]:
    """Raise with every source in error; otherwise the sources to be warned of. A row per source."""
    found = results.where("status <> 'pass'").orderBy("source").collect()
    stale = [f"{r.source}: latest load {r.latest}" for r in found if r.status == "error"]
    if stale:
        raise StaleSource("; ".join(stale))
    return [r.source for r in found]
