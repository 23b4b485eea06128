"""Landed files written by Spark from the proxy views, for the source queries to parse back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroweather.operators import latest_per_key
from agroweather.schemas import WEATHER_VARIABLES


def weather_points(raw_weather: DataFrame) -> DataFrame:
    return raw_weather.select(
        "fips", F.col("latitude").alias("lat"), F.col("longitude").alias("lon")
    ).distinct()


def weather_payloads(raw_weather: DataFrame, batches: DataFrame) -> DataFrame:
    """``(batch_id, body)``: one response per batch, a bare object where it has one point.

    Days are deduplicated first, so a block holds at most one entry per day, and
    a response at most one block per point of its batch. Rows are placed by county once,
    for both; those without a county are in no batch.
    """
    place = batches.select("batch_id", F.posexplode("fips_list").alias("place", "fips"))
    by_county = raw_weather.dropna(subset=["fips"]).repartition("fips")
    days = latest_per_key(by_county, ["fips", "date"], "_ingested_at")
    blocks = (
        days.groupBy("fips", "latitude", "longitude")
        .agg(F.sort_array(F.collect_list(F.struct("date", *WEATHER_VARIABLES))).alias("days"))
        .select(
            "fips",
            F.struct(
                "latitude",
                "longitude",
                F.struct(
                    F.col("days.date").alias("time"),
                    *[F.col(f"days.{name}").alias(name) for name in WEATHER_VARIABLES],
                ).alias("daily"),
            ).alias("block"),
        )
    )
    responses = (
        blocks.join(place, "fips")
        .groupBy("batch_id")
        .agg(F.sort_array(F.collect_list(F.struct("place", "block"))).alias("placed"))
        .select("batch_id", F.col("placed.block").alias("points"))
    )
    return responses.select(
        "batch_id",
        F.when(F.size("points") == 1, F.to_json(F.col("points")[0]))
        .otherwise(F.to_json("points"))
        .alias("body"),
    )


def yield_payloads(raw_yields: DataFrame) -> DataFrame:
    """``(body)``: one response per commodity, state, year and block of 1,000 county codes.

    ``agg_level_desc`` and the name of county 000 are left out, a field outside
    the contract is added.
    """
    record = F.struct(
        "state_alpha",
        "state_fips_code",
        "county_code",
        F.when(F.col("county_code") != "000", F.col("county_name")).alias("county_name"),
        "commodity_desc",
        "statisticcat_desc",
        "short_desc",
        "unit_desc",
        F.col("year").cast("string").alias("year"),
        F.col("value_raw").alias("Value"),
        F.lit("2026-01-15 00:00:00").alias("load_time"),
    )
    return (
        raw_yields.groupBy("commodity_desc", "state_alpha", "year", "state_fips_code")
        .agg(F.collect_list(record).alias("data"))
        .select(F.to_json(F.struct("data")).alias("body"))
    )


def write_gazetteer(counties: DataFrame, path: str) -> None:
    """Pipe-delimited county file with padded header names and padded coordinates."""
    counties.select(
        F.col("state_alpha").alias("USPS"),
        F.col("fips").alias("GEOID "),
        F.col("county_name").alias("NAME"),
        F.concat(F.lit(" "), F.col("lat").cast("string")).alias(" INTPTLAT"),
        F.concat(F.col("lon").cast("string"), F.lit("   ")).alias("INTPTLONG      "),
    ).write.mode("overwrite").option("sep", "|").option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
