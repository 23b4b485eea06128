"""Staging: cleaned, deduplicated, typed views of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroweather.functions import bu_acre_to_t_ha, county_fips, is_county_code, parse_yield
from agroweather.operators.dedupe import latest_per_key
from agroweather.schemas import INGEST_STAMP, STAGED_WEATHER, WEATHER_VARIABLES

# Staged names of the payload variables that change name.
STAGED_NAMES = {
    "shortwave_radiation_sum": "solar_radiation_mjm2",
    "windspeed_10m_max": "wind_speed_kmh",
}

# The statistic and unit a staged yield is reported in.
GRAIN_STATISTIC = "YIELD"
GRAIN_UNIT = "BU / ACRE"


def stage_weather(raw: DataFrame) -> DataFrame:
    """``stg_weather_daily``: the latest load of every (fips, date), units in the names."""
    return _latest_weather(raw, ["fips", "date"]).select(*STAGED_WEATHER.names)


def _latest_weather(raw: DataFrame, keys: list[str]) -> DataFrame:
    observed = raw.select(*keys, *WEATHER_VARIABLES, INGEST_STAMP)
    return latest_per_key(observed, keys, INGEST_STAMP).withColumnsRenamed(STAGED_NAMES)


def stage_weather_in_order(raw: DataFrame, order: list[str]) -> DataFrame:
    """:func:`stage_weather`, placed by ranges of ``order`` for a writer that wants this order.

    ``order`` holds fips, date and columns of ``raw`` that follow from them, which stay in
    the result. The rows are shuffled and sorted once: a range keeps the copies of a key
    together, so that neither the deduplication nor a writer by the first columns moves or
    sorts them again, and a large day or month is split over tasks between two keys. The
    copies of one key, one for each load, meet in one task.
    """
    rest = [name for name in order if name not in STAGED_WEATHER.names]
    observed = raw.select(*order, *WEATHER_VARIABLES, INGEST_STAMP).repartitionByRange(*order)
    return _latest_weather(observed, order).select(*STAGED_WEATHER.names, *rest)


def stage_yields(raw: DataFrame) -> DataFrame:
    """``stg_nass_yield``: county grain yields with a county key and numeric values.

    Suppressed values stay as NULL rows, an unknown commodity stays with a NULL
    t/ha, and a repeated (fips, commodity, year) stays for the checks to report.
    """
    grain = raw.filter(
        (F.col("statisticcat_desc") == F.lit(GRAIN_STATISTIC))
        & (F.col("unit_desc") == F.lit(GRAIN_UNIT))
        & is_county_code(F.col("county_code"))
    )
    parsed = grain.select(
        county_fips(F.col("state_fips_code"), F.col("county_code")).alias("fips"),
        F.lower("commodity_desc").alias("commodity"),
        "state_alpha",
        "year",
        F.col("unit_desc").alias("unit"),
        parse_yield(F.col("value_raw")).alias("yield_value"),
        INGEST_STAMP,
    )
    return parsed.select(
        "fips",
        "commodity",
        "state_alpha",
        "year",
        "unit",
        "yield_value",
        bu_acre_to_t_ha(F.col("yield_value"), F.col("commodity")).alias("yield_value_t_ha"),
        INGEST_STAMP,
    )
