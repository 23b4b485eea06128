"""Landed source files to raw tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from agroweather.operators.batching import BATCH_SIZE, point_batches
from agroweather.operators.gate import (
    RECORD_LIMIT,
    enforce_record_limit,
    record_counts,
    work_list,
)
from agroweather.operators.probes import year_is_loaded
from agroweather.operators.publish import REPLACE_TABLE
from agroweather.operators.sinks import land_bronze, load_raw
from agroweather.schemas import INGEST_STAMP, RAW_WEATHER, RAW_YIELD, WEATHER_VARIABLES
from agroweather.sources.constants import constant_rows
from agroweather.sources.counties import read_gazetteer
from agroweather.sources.lake import Lake
from agroweather.sources.weather_payload import (
    attach_points,
    landed_keys,
    parse_weather_payloads,
    read_payloads,
)
from agroweather.sources.yield_payload import in_scope, parse_yield_payloads

# The default scope of a run.
TARGET_STATES = ["IA", "IL", "IN", "NE", "MN"]
TARGET_COMMODITIES = ["CORN", "SOYBEANS"]
WINDOW_START = date(2025, 4, 1)
WINDOW_END = date(2025, 10, 31)
TARGET_YEAR = 2025

STATES = StructType([StructField("state_alpha", StringType())])
WEATHER_TABLE = "weather_daily"
YIELD_TABLE = "nass_yield"
POINT_BATCHES = "point_batches"


@dataclass(frozen=True)
class LoadReport:
    """Outcome of an ingestion run."""

    status: str
    rows: int = 0


def _stamp(df: DataFrame, ingested_at: datetime | None) -> DataFrame:
    """One constant UTC instant on every row, fixed here and not re-read per task."""
    return df.withColumn(INGEST_STAMP, F.lit(ingested_at or datetime.now(timezone.utc)))


def request_batches(points: DataFrame, path: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Point batches, written once to ``path``: the list of requests that were to be answered.

    Read back, their size in bytes is known to the planner, which broadcasts them
    to the response texts below the session's threshold and sorts and merges above it.
    """
    batches = point_batches(points, batch_size)
    batches.write.mode("overwrite").parquet(path)
    return points.sparkSession.read.schema(batches.schema).parquet(path)


def ingest_weather(
    spark: SparkSession,
    payload_path: str,
    points: DataFrame,
    lake: Lake,
    *,
    start: date = WINDOW_START,
    end: date = WINDOW_END,
    variables: list[str] | None = None,
    batch_size: int = BATCH_SIZE,
    ingested_at: datetime | None = None,
    replace: str = REPLACE_TABLE,
) -> LoadReport:
    """Landed weather responses to raw ``weather_daily``.

    ``<payload_path>/batch_id=<n>/`` holds the responses to point batch ``n``,
    one JSON document per file; every batch has to be answered. Days outside
    [start, end] are not loaded, variables left out are NULL in raw.
    ``replace="partitions"`` keeps the days of other windows in raw. A stamp
    given as ``ingested_at`` has to carry its time zone.
    """
    variables = variables or WEATHER_VARIABLES
    batches = request_batches(points, lake.staging(POINT_BATCHES), batch_size)
    answered = landed_keys(spark, payload_path, "batch_id")
    missing = batches.join(answered, "batch_id", "left_anti").select("batch_id").head(1)
    if missing:
        raise ValueError(f"no response for batch {missing[0].batch_id}")

    payloads = read_payloads(spark, payload_path, "batch_id")
    observed = parse_weather_payloads(attach_points(payloads, batches), variables).filter(
        F.col("date").between(F.lit(start), F.lit(end))
    )
    unread = {
        name: F.lit(None).cast("double") for name in WEATHER_VARIABLES if name not in variables
    }
    rows = _stamp(observed.withColumns(unread) if unread else observed, ingested_at)
    land_bronze(rows.select(*RAW_WEATHER.names), lake.bronze(WEATHER_TABLE), "date")
    n_rows = load_raw(
        spark,
        lake.bronze(WEATHER_TABLE),
        lake.raw(WEATHER_TABLE),
        RAW_WEATHER,
        partition_by="date",
        cluster_by=["fips"],
        replace=replace,
        log_path=lake.loads(WEATHER_TABLE),
    )
    return LoadReport("loaded", n_rows)


def ingest_yield(
    spark: SparkSession,
    payload_path: str,
    lake: Lake,
    *,
    one_per_file: bool = True,
    commodities: list[str] | None = None,
    states: list[str] | None = None,
    year: int = TARGET_YEAR,
    limit: int = RECORD_LIMIT,
    ingested_at: datetime | None = None,
    replace: str = REPLACE_TABLE,
) -> LoadReport:
    """Landed yield responses to raw ``nass_yield``, refused whole if a cell is too large.

    A file under ``payload_path`` is one JSON document, or one per line with
    ``one_per_file=False``.
    """
    commodities = commodities or TARGET_COMMODITIES
    states = states or TARGET_STATES
    records = in_scope(
        parse_yield_payloads(read_payloads(spark, payload_path, one_per_file=one_per_file)),
        commodities=commodities,
        states=states,
        year=year,
    )
    cells = work_list(
        constant_rows(spark, [(state,) for state in states], STATES),
        commodities,
        [year],
    )
    enforce_record_limit(record_counts(records, cells, limit))

    rows = _stamp(records, ingested_at).select(*RAW_YIELD.names)
    land_bronze(rows, lake.bronze(YIELD_TABLE), "year")
    n_rows = load_raw(
        spark,
        lake.bronze(YIELD_TABLE),
        lake.raw(YIELD_TABLE),
        RAW_YIELD,
        partition_by="year",
        cluster_by=["state_alpha", "commodity_desc"],
        replace=replace,
        log_path=lake.loads(YIELD_TABLE),
    )
    return LoadReport("loaded", n_rows)


def ingest_yield_if_new(
    spark: SparkSession, payload_path: str, lake: Lake, *, year: int = TARGET_YEAR, **options
) -> LoadReport:
    """:func:`ingest_yield`, skipped when raw already holds the year."""
    if year_is_loaded(spark, lake.raw(YIELD_TABLE), year):
        return LoadReport("skipped")
    return ingest_yield(spark, payload_path, lake, year=year, **options)


def county_seed(gazetteer: DataFrame, states: list[str]) -> DataFrame:
    """Centroid rows of the given states, as text, in ``fips`` order."""
    return (
        gazetteer.filter(F.col("USPS").isin(states))
        .select(
            F.col("GEOID").alias("fips"),
            F.col("USPS").alias("state_alpha"),
            F.col("NAME").alias("county_name"),
            F.trim("INTPTLAT").alias("lat"),
            F.trim("INTPTLONG").alias("lon"),
        )
        .orderBy("fips")
    )


def build_county_seed(
    spark: SparkSession, gazetteer_path: str, output: str, states: list[str] | None = None
) -> int:
    """Gazetteer to the centroid seed (headed CSV, sorted by ``fips``); returns the row count.

    The sort is by range, so a large seed is several files in order and a small
    one is a single file.
    """
    seen = Observation()
    seed = county_seed(read_gazetteer(spark, gazetteer_path), states or TARGET_STATES)
    (
        seed.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .csv(output)
    )
    return seen.get["rows"]
