"""Per-day weather expressions behind the season features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the season features.
GDD_BASE_C = 10.0
HEAT_STRESS_ABOVE_C = 30.0
DRY_BELOW_MM = 1.0


def growing_degrees(tmax: Column, tmin: Column, base: float = GDD_BASE_C) -> Column:
    """Degrees of the daily mean above the base, never negative, NULL when a temperature is NULL.

    ``greatest`` skips NULLs, which would turn an unknown day into a zero day,
    so the day is guarded first.
    """
    above_base = (tmax + tmin) / F.lit(2.0) - F.lit(float(base))
    return F.when(above_base.isNotNull(), F.greatest(F.lit(0.0), above_base))


def is_heat_stress_day(tmax: Column, above: float = HEAT_STRESS_ABOVE_C) -> Column:
    """Strictly above the threshold. Spark orders NaN above every number, so NaN is excluded."""
    return (tmax > F.lit(float(above))) & ~F.isnan(tmax)


def is_dry_day(precipitation: Column, below: float = DRY_BELOW_MM) -> Column:
    """Strictly below the threshold; NaN is never below."""
    return precipitation < F.lit(float(below))
