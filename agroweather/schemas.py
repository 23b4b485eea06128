"""Table contracts: column order, types and required fields of every layer.

File sources make every column nullable on read, so the required fields are
kept here (``nullable=False``) and enforced by the raw loaders.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The daily variables of the weather payload, in contract order.
WEATHER_VARIABLES = [
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "precipitation_sum",
    "et0_fao_evapotranspiration",
    "shortwave_radiation_sum",
    "windspeed_10m_max",
]

# The text fields kept from a yield record.
YIELD_TEXT_FIELDS = [
    "state_alpha",
    "state_fips_code",
    "county_code",
    "county_name",
    "commodity_desc",
    "statisticcat_desc",
    "agg_level_desc",
    "short_desc",
    "unit_desc",
]

INGEST_STAMP = "_ingested_at"


def _fields(*pairs: tuple) -> list[StructField]:
    return [StructField(name, kind, not required) for name, kind, required in pairs]


RAW_WEATHER = StructType(
    _fields(
        ("fips", StringType(), True),
        ("latitude", DoubleType(), False),
        ("longitude", DoubleType(), False),
        ("date", DateType(), True),
        *[(name, DoubleType(), False) for name in WEATHER_VARIABLES],
        (INGEST_STAMP, TimestampType(), True),
    )
)

RAW_YIELD = StructType(
    _fields(
        *[(name, StringType(), False) for name in YIELD_TEXT_FIELDS],
        ("year", LongType(), False),
        ("value_raw", StringType(), False),
        (INGEST_STAMP, TimestampType(), True),
    )
)

COUNTY_CENTROIDS = StructType(
    _fields(
        ("fips", StringType(), False),
        ("state_alpha", StringType(), False),
        ("county_name", StringType(), False),
        ("lat", DoubleType(), False),
        ("lon", DoubleType(), False),
    )
)

DIM_COMMODITY = StructType(
    _fields(
        ("commodity", StringType(), False),
        ("display_name", StringType(), False),
        ("gdd_base_c", LongType(), False),
        ("bushel_weight_lb", LongType(), False),
    )
)

DIM_DATE = StructType(
    _fields(
        ("date", DateType(), False),
        ("year", LongType(), False),
        ("month", LongType(), False),
        ("day", LongType(), False),
        ("day_of_year", LongType(), False),
        ("is_growing_season", BooleanType(), False),
    )
)

STAGED_WEATHER = StructType(
    _fields(
        ("fips", StringType(), False),
        ("date", DateType(), False),
        ("temperature_2m_max", DoubleType(), False),
        ("temperature_2m_min", DoubleType(), False),
        ("temperature_2m_mean", DoubleType(), False),
        ("precipitation_sum", DoubleType(), False),
        ("et0_fao_evapotranspiration", DoubleType(), False),
        ("solar_radiation_mjm2", DoubleType(), False),
        ("wind_speed_kmh", DoubleType(), False),
        (INGEST_STAMP, TimestampType(), False),
    )
)

SEASON_FEATURES = StructType(
    _fields(
        ("fips", StringType(), False),
        ("year", LongType(), False),
        ("gdd", DoubleType(), False),
        ("precip_total_mm", DoubleType(), False),
        ("heat_stress_days", LongType(), False),
        ("dry_days", LongType(), False),
        ("et0_total_mm", DoubleType(), False),
        ("radiation_mean", DoubleType(), False),
        ("tmax_mean", DoubleType(), False),
        ("tmin_mean", DoubleType(), False),
    )
)

CROP_YIELD = StructType(
    _fields(
        ("fips", StringType(), False),
        ("commodity", StringType(), False),
        ("state_alpha", StringType(), False),
        ("year", LongType(), False),
        ("yield_value", DoubleType(), False),
        ("yield_value_t_ha", DoubleType(), False),
        ("unit", StringType(), False),
        (INGEST_STAMP, TimestampType(), False),
    )
)

ANALYSIS = StructType(
    _fields(
        ("fips", StringType(), False),
        ("state_alpha", StringType(), False),
        ("county_name", StringType(), False),
        ("commodity", StringType(), False),
        ("year", LongType(), False),
        ("yield_value", DoubleType(), False),
        ("yield_value_t_ha", DoubleType(), False),
        ("unit", StringType(), False),
        ("gdd", DoubleType(), False),
        ("precip_total_mm", DoubleType(), False),
        ("heat_stress_days", LongType(), False),
        ("dry_days", LongType(), False),
        ("et0_total_mm", DoubleType(), False),
        ("tmax_mean", DoubleType(), False),
    )
)


def required_columns(schema: StructType) -> list[str]:
    return [field.name for field in schema if not field.nullable]
