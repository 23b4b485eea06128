"""Dimensions, facts and the analysis mart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroweather.functions import in_season
from agroweather.functions.calendar import SEASON_END, SEASON_START
from agroweather.operators.sinks import refresh_from_watermark
from agroweather.schemas import ANALYSIS, COUNTY_CENTROIDS, CROP_YIELD, DIM_COMMODITY, STAGED_WEATHER
from agroweather.sources.constants import constant_rows

# Commodity, display name, growing-degree base in °C, bushel weight in lb.
COMMODITIES = [
    ("corn", "Corn", 10, 56),
    ("soybeans", "Soybeans", 10, 60),
]

# The order the weather fact is stored in: days, within them counties.
FACT_ORDER = ["date", "fips"]

# The calendar the date dimension covers by default.
CALENDAR_START = date(2025, 1, 1)
CALENDAR_END = date(2025, 12, 31)


def county_dimension(centroids: DataFrame) -> DataFrame:
    """``dim_county``"""
    return centroids.select(*COUNTY_CENTROIDS.names)


def commodity_dimension(spark: SparkSession) -> DataFrame:
    """``dim_commodity``"""
    return constant_rows(spark, COMMODITIES, DIM_COMMODITY)


def calendar(
    bounds: DataFrame,
    first: Column,
    last: Column,
    season_start: str = SEASON_START,
    season_end: str = SEASON_END,
) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included, of each row of ``bounds``."""
    day = F.col("date")
    return bounds.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date")
    ).select(
        "date",
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        F.dayofyear(day).cast("bigint").alias("day_of_year"),
        in_season(day, season_start, season_end).alias("is_growing_season"),
    )


def date_dimension(
    spark: SparkSession,
    first: date = CALENDAR_START,
    last: date = CALENDAR_END,
    season_start: str = SEASON_START,
    season_end: str = SEASON_END,
) -> DataFrame:
    """``dim_date``"""
    return calendar(spark.range(1), F.lit(first), F.lit(last), season_start, season_end)


def refresh_weather_fact(
    spark: SparkSession, staged: DataFrame, path: str, placed: bool = False
) -> None:
    """``fact_weather_daily``: incremental by date, rows of a day ordered by county.

    ``placed`` rows come in this order (``stage_weather_in_order`` by ``FACT_ORDER``).
    """
    refresh_from_watermark(
        spark,
        staged.select(*STAGED_WEATHER.names),
        path,
        watermark="date",
        cluster_by=["fips"],
        rebalance=not placed,
    )


def crop_yield_fact(staged: DataFrame) -> DataFrame:
    """``fact_crop_yield``"""
    return staged.select(*CROP_YIELD.names)


def weather_yield_analysis(
    yields: DataFrame, features: DataFrame, counties: DataFrame
) -> DataFrame:
    """``weather_yield_analysis``: yields of counties with season weather and a centroid.

    The features, one row per county and year, meet the county names first, so
    the yields are shuffled once. No side is forced to be broadcast: the planner
    and adaptive execution do it when the measured size is under the session's
    threshold, and otherwise sort-merge with skewed partitions split.
    """
    located = features.join(counties.select("fips", "state_alpha", "county_name"), "fips")
    measures = yields.select(
        "fips", "year", "commodity", "yield_value", "yield_value_t_ha", "unit"
    )
    return measures.join(located, ["fips", "year"]).select(*ANALYSIS.names)
