"""Landed weather responses to one row per point and day.

A request asks for up to ``batch_size`` points; its response holds one block per
point in request order (a bare object when there is one point), and each block
holds parallel arrays: ``time`` and one array per daily variable.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroweather.functions import iso_date
from agroweather.schemas import WEATHER_VARIABLES


def read_payloads(
    spark: SparkSession, path: str, key: str | None = None, *, one_per_file: bool = True
) -> DataFrame:
    """Landed response bodies, as ``(key, body)`` or ``(body)``.

    ``key`` names a numeric folder level ``<key>=<n>``. A file is one document,
    or with ``one_per_file=False`` one document per line, which Spark can split.
    """
    schema = "value string" if key is None else f"value string, {key} bigint"
    text = spark.read.schema(schema).text(path, wholetext=one_per_file)
    return text.select(*([key] if key else []), F.col("value").alias("body"))


def landed_keys(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Distinct values of the folder level ``<key>=<n>``, from the file listing alone."""
    listing = spark.read.format("binaryFile").load(path)
    return listing.select(F.col(key).cast("bigint").alias(key)).distinct()


def attach_points(payloads: DataFrame, batches: DataFrame) -> DataFrame:
    """Give each landed response the ordered point list of its request."""
    return payloads.join(batches.select("batch_id", "fips_list"), "batch_id", "left")


def _require(condition: Column, value: Column, message: str) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(
        F.raise_error(F.lit(message))
    )


def _payload_type(variables: list[str]) -> str:
    arrays = ", ".join(f"`{name}`: array<double>" for name in variables)
    daily = f"struct<time: array<string>, {arrays}>"
    return f"array<struct<latitude: double, longitude: double, daily: {daily}>>"


def parse_weather_payloads(
    payloads: DataFrame, variables: list[str] | None = None
) -> DataFrame:
    """``(fips_list, body)`` to ``(fips, latitude, longitude, date, <variables>)``.

    Coordinates come from the response. A response of the wrong length, a
    missing variable, a variable with fewer values than days, or a bad date
    fails the job; values beyond the last day are ignored. The checks guard the
    arrays that get exploded, so they also run when only some columns are read.
    """
    variables = variables or WEATHER_VARIABLES
    blocks = payloads.select(
        "fips_list",
        F.from_json("body", _payload_type(variables), {"mode": "FAILFAST"}).alias("points"),
    )
    pairs = blocks.select(
        F.explode(
            _require(
                F.size("points") == F.size("fips_list"),
                F.arrays_zip("fips_list", "points"),
                "response does not hold one block per requested point",
            )
        ).alias("pair")
    ).select(
        F.col("pair.fips_list").alias("fips"),
        F.col("pair.points.latitude").alias("latitude"),
        F.col("pair.points.longitude").alias("longitude"),
        F.col("pair.points.daily").alias("daily"),
    )

    n_days = F.size("daily.time")
    has_all_days = [
        (n_days == 0) | (F.col(f"daily.{name}").isNotNull() & (F.size(f"daily.{name}") >= n_days))
        for name in variables
    ]
    complete = reduce(
        and_,
        has_all_days,
        F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & F.col("daily.time").isNotNull(),
    )
    columns = [F.col("daily.time").alias("time")] + [
        F.when(F.size(f"daily.{name}") == n_days, F.col(f"daily.{name}"))
        .otherwise(F.slice(f"daily.{name}", F.lit(1), n_days))
        .alias(name)
        for name in variables
    ]
    per_point = pairs.select(
        "fips", "latitude", "longitude", complete.alias("complete"), *columns
    )
    days = per_point.select(
        "fips",
        "latitude",
        "longitude",
        F.explode(
            _require(
                F.col("complete"),
                F.arrays_zip("time", *variables),
                "block lacks coordinates, days, or a value for each day",
            )
        ).alias("day"),
    )
    return days.select(
        "fips",
        "latitude",
        "longitude",
        iso_date(F.col("day.time")).alias("date"),
        *[F.col(f"day.{name}").alias(name) for name in variables],
    )
