"""Raw weather, raw yields and counties derived from the star-schema tables.

Supplier stands for county, ship date for observation date, return flag for
commodity. Measures are multiples of 1/4, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroweather.schemas import COUNTY_CENTROIDS, RAW_WEATHER, RAW_YIELD


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _state_code(key: str) -> Column:
    """In base 36, so that two characters hold the states of 1,295,000 suppliers; more are an error."""
    state = F.lit(1) + F.expr(f"{key} div 1000")
    wide = F.raise_error(F.lit("a state of two characters holds suppliers up to 1,294,999")).cast("string")
    return F.when((state < 36 * 36) | state.isNull(), F.conv(state.cast("string"), 10, 36)).otherwise(wide)


def _county_code(key: str) -> Column:
    return F.lpad((F.col(key) % 1000).cast("string"), 3, "0")


def _fips(key: str) -> Column:
    return F.concat(F.lpad(_state_code(key), 2, "0"), _county_code(key))


def _latitude(key: str) -> Column:
    return F.lit(37.0) + (F.col(key) % 96) / F.lit(8.0)


def _longitude(key: str) -> Column:
    return F.lit(-84.0) - (F.col(key) % 160) / F.lit(8.0)


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates on (fips, date), NULL maxima and NULL means included."""
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    return (
        _table(spark, sf_dir, "lineitem")
        .select(
            _fips("l_suppkey").alias("fips"),
            _latitude("l_suppkey").alias("latitude"),
            _longitude("l_suppkey").alias("longitude"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.when(~((line == 7) & (F.col("l_orderkey") % 13 == 0)), quantity - 5).alias(
                "temperature_2m_max"
            ),
            (quantity - 10 - line).alias("temperature_2m_min"),
            F.when(line != 1, quantity - 8).alias("temperature_2m_mean"),
            (F.round(F.col("l_discount") * 100) / 4).alias("precipitation_sum"),
            (F.round(F.col("l_tax") * 100) / 2).alias("et0_fao_evapotranspiration"),
            (quantity / 2).alias("shortwave_radiation_sum"),
            (line * 4).cast("double").alias("windspeed_10m_max"),
            F.timestamp_seconds(F.lit(1735689600) + F.col("l_orderkey") * 8 + line).alias(
                "_ingested_at"
            ),
        )
        .select(*RAW_WEATHER.names)
    )


def raw_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppression flags, blanks, thousands separators, other units and statistics included."""
    n = F.col("n")
    per_supplier = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(
            "l_suppkey", F.year("l_shipdate").cast("bigint").alias("year"), "l_returnflag"
        )
        .agg((F.sum("l_quantity") * 2).cast("bigint").alias("n"))
    )
    value_raw = (
        F.when(n % 7 == 0, F.lit(" (D)"))
        .when(n % 11 == 0, F.lit("(Z)"))
        .when(
            n >= 1000,
            F.concat_ws(
                ",",
                F.expr("n div 1000").cast("string"),
                F.lpad((n % 1000).cast("string"), 3, "0"),
            ),
        )
        .otherwise(F.concat(n.cast("string"), F.lit(".5")))
    )
    return (
        per_supplier.join(
            _table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey")
        )
        .join(_table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            F.col("n_name").alias("state_alpha"),
            _state_code("l_suppkey").alias("state_fips_code"),
            _county_code("l_suppkey").alias("county_code"),
            F.col("s_name").alias("county_name"),
            F.when(F.col("l_returnflag") == "A", F.lit("CORN"))
            .when(F.col("l_returnflag") == "N", F.lit("SOYBEANS"))
            .otherwise(F.lit("WHEAT"))
            .alias("commodity_desc"),
            F.when(n % 17 == 0, F.lit("PRODUCTION"))
            .otherwise(F.lit("YIELD"))
            .alias("statisticcat_desc"),
            F.lit("COUNTY").alias("agg_level_desc"),
            F.lit("").alias("short_desc"),
            F.when(n % 13 == 0, F.lit("TONS / ACRE"))
            .otherwise(F.lit("BU / ACRE"))
            .alias("unit_desc"),
            "year",
            value_raw.alias("value_raw"),
            F.to_timestamp(F.lit("2026-01-15 00:00:00")).alias("_ingested_at"),
        )
        .select(*RAW_YIELD.names)
    )


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth supplier is left out, so some keys have no county."""
    return (
        _table(spark, sf_dir, "supplier")
        .filter(F.col("s_suppkey") % 10 != 9)
        .join(_table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            _fips("s_suppkey").alias("fips"),
            F.col("n_name").alias("state_alpha"),
            F.col("s_name").alias("county_name"),
            _latitude("s_suppkey").alias("lat"),
            _longitude("s_suppkey").alias("lon"),
        )
        .select(*COUNTY_CENTROIDS.names)
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation").select(F.col("n_name").alias("state_alpha"))
