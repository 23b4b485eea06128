"""Summaries the mart is meant for: state yields and weather-yield correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = [
    "gdd",
    "precip_total_mm",
    "heat_stress_days",
    "dry_days",
    "et0_total_mm",
    "tmax_mean",
]


def state_yields(crop_yields: DataFrame) -> DataFrame:
    """Unweighted state figures from county rows; suppressed counties do not count."""
    value = F.col("yield_value")
    return crop_yields.groupBy("state_alpha", "commodity", "year").agg(
        F.avg(value).alias("yield_mean"),
        F.min(value).alias("yield_min"),
        F.max(value).alias("yield_max"),
        F.count(value).alias("n_counties"),
    )


def weather_yield_correlation(mart: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Pearson correlation of yield with each season feature, per commodity, in one pass."""
    features = features or FEATURES
    correlations = mart.groupBy("commodity").agg(
        *[F.corr("yield_value", F.col(name).cast("double")).alias(name) for name in features]
    )
    return correlations.unpivot("commodity", features, "feature", "correlation")
