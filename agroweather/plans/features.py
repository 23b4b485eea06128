"""Growing-season weather features per county and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroweather.functions import growing_degrees, in_season, is_dry_day, is_heat_stress_day
from agroweather.functions.calendar import SEASON_END, SEASON_START
from agroweather.schemas import SEASON_FEATURES


def season_features(
    staged: DataFrame, start: str = SEASON_START, end: str = SEASON_END
) -> DataFrame:
    """``int_weather_growing_season``: one row per (fips, year) of in-season days.

    The season filter is on ``date``, a key of the deduplication above it, so it
    moves down to the scan and prunes date partitions.

    ``year`` becomes a bigint after the grouping, not before. The grouped rows
    are then no longer known to be placed by the final key, a later join on it
    shuffles both sides itself, and adaptive execution may split a skewed one.
    """
    tmax, tmin = F.col("temperature_2m_max"), F.col("temperature_2m_min")
    precipitation = F.col("precipitation_sum")
    return (
        staged.filter(in_season(F.col("date"), start, end))
        .groupBy("fips", F.year("date").alias("calendar_year"))
        .agg(
            F.sum(growing_degrees(tmax, tmin)).alias("gdd"),
            F.sum(precipitation).alias("precip_total_mm"),
            F.count_if(is_heat_stress_day(tmax)).alias("heat_stress_days"),
            F.count_if(is_dry_day(precipitation)).alias("dry_days"),
            F.sum("et0_fao_evapotranspiration").alias("et0_total_mm"),
            F.avg("solar_radiation_mjm2").alias("radiation_mean"),
            F.avg(tmax).alias("tmax_mean"),
            F.avg(tmin).alias("tmin_mean"),
        )
        .withColumn("year", F.col("calendar_year").cast("bigint"))
        .select(*SEASON_FEATURES.names)
    )
