"""Features and yields stored by buckets of county and year, for joins without a shuffle.

The mart join shuffles the yields, and both sides where neither is small. Where the
two are joined again and again (other measures, other years), they are stored once
by buckets of the join key instead. A county with very many rows is spread by its
years; both tables hold a county and year only a few times by their definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agroweather.operators.bucketing import bucketed_table, write_bucketed
from agroweather.plans.marts import weather_yield_analysis
from agroweather.schemas import CROP_YIELD, SEASON_FEATURES
from agroweather.sources.lake import Lake

PLACED_BY = ["fips", "year"]
COLOCATED = {"colocated_features": SEASON_FEATURES, "colocated_yields": CROP_YIELD}


def store_colocated(
    features: DataFrame, yields: DataFrame, lake: Lake, buckets: int, prefix: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Both tables written by ``buckets`` buckets; ``prefix`` sets their names in the catalog apart."""
    made = zip(COLOCATED.items(), (features, yields), strict=True)
    written = [
        write_bucketed(df.select(*schema.names), prefix + name, lake.staging(name), PLACED_BY, buckets)
        for (name, schema), df in made
    ]
    return written[0], written[1]


def open_colocated(
    spark: SparkSession, lake: Lake, buckets: int, prefix: str = ""
) -> tuple[DataFrame, DataFrame]:
    """The tables that :func:`store_colocated` wrote with as many buckets, for another session."""
    opened = [
        bucketed_table(spark, prefix + name, lake.staging(name), schema, PLACED_BY, buckets)
        for name, schema in COLOCATED.items()
    ]
    return opened[0], opened[1]


def colocated_analysis(features: DataFrame, yields: DataFrame, counties: DataFrame) -> DataFrame:
    """``weather_yield_analysis`` of the bucketed tables: no shuffle while the county names are broadcast."""
    return weather_yield_analysis(yields, features, counties)
