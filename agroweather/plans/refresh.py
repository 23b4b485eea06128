"""Refreshing stored tables by what changed in raw, told from the file listing alone.

A month or day of raw is known by its files (path, length and time of change); no
file is opened. What the last finished refresh saw is kept beside the tables as a
ledger, written last, so after an interruption the next refresh finds the same
changes and redoes them.

- Staging: the deduplicated weather by month, the season features by year. A refresh
  redoes exactly the months whose files changed and the years of those months,
  however far apart they lie; months gone from raw leave staging.
- The weather fact takes the newest days by its watermark. Windows loaded late lie
  before it: ``FACT_CHANGED`` takes the days whose files changed instead,
  ``FACT_FULL`` everything.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from agroweather.functions.calendar import SEASON_END, SEASON_START, season_months
from agroweather.operators.probes import listed_files
from agroweather.operators.publish import REPLACE_PARTITIONS, REPLACE_TABLE, recover
from agroweather.operators.sinks import write_partitioned, write_table
from agroweather.plans.features import season_features
from agroweather.plans.marts import FACT_ORDER, refresh_weather_fact
from agroweather.plans.staging import stage_weather_in_order
from agroweather.schemas import SEASON_FEATURES, STAGED_WEATHER
from agroweather.session import remove_folder
from agroweather.sources.lake import Lake, is_committed, read_table, table_or_none

STAGED = "stg_weather_daily"
FEATURES = "int_weather_growing_season"
LEDGER = "staged_months"
SEEN = "seen_months"
MONTH = "month"

LEDGER_SCHEMA = "month date, files long, digest long"
DAYS_SCHEMA = "date date, files long, digest long"
STAGED_BY_MONTH = StructType([*STAGED_WEATHER.fields, StructField(MONTH, DateType())])


# How the stored fact is brought up to date.
FACT_WATERMARK = "watermark"
FACT_CHANGED = "changed"
FACT_FULL = "full"
FACT_DAYS = "fact_days"
SEEN_DAYS = "seen_days"
CHANGED_DAYS = "changed_days"


def raw_files(spark: SparkSession, raw_path: str, period: Column) -> DataFrame:
    """``(period, files, digest)`` of a table partitioned by ``date``, without opening a file."""
    return folder_files(spark, raw_path, "date", period, "date")


def folder_files(
    spark: SparkSession, path: str, column: str, period: Column, kind: str | None = None
) -> DataFrame:
    """:func:`raw_files` of a table partitioned by ``column``, whose values are read as ``kind``."""
    return (
        listed_files(spark, path, column, kind)
        .select(
            period.alias("period"),
            F.xxhash64("path", "length", "modificationTime").alias("file"),
        )
        .groupBy("period")
        .agg(F.count(F.lit(1)).alias("files"), F.bit_xor("file").alias("digest"))
    )


def raw_months(spark: SparkSession, raw_path: str) -> DataFrame:
    return raw_files(spark, raw_path, F.trunc("date", "month")).withColumnRenamed("period", MONTH)


def changes(seen: DataFrame, before: DataFrame, period: str) -> DataFrame:
    """``(period, gone)`` for each period that is new, changed or no longer there."""
    old = before.select(period, F.struct("files", "digest").alias("old"))
    new = seen.select(period, F.struct("files", "digest").alias("new"))
    return (
        new.join(old, period, "full_outer")
        .where(~F.col("new").eqNullSafe(F.col("old")))
        .select(period, F.col("new").isNull().alias("gone"))
    )


def changed_months(seen: DataFrame, before: DataFrame) -> list[date | None]:
    """The months to redo, one value for each; None stands for days without a date."""
    return [row.month for row in changes(seen, before, MONTH).select(MONTH).collect()]


def _folder(column: str, value: date | int | None) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def among(column: Column, values: Iterable) -> Column:
    """Whether the column has one of the values, NULL among them; prunes as a partition filter."""
    known = [value for value in values if value is not None]
    found = column.isin(known) if known else F.lit(False)
    return found | column.isNull() if None in values else found


def _write_staged(raw: DataFrame, path: str, replace: str, drop: Iterable[str] = ()) -> None:
    by_month = raw.withColumn(MONTH, F.trunc("date", "month"))
    staged = stage_weather_in_order(by_month, [MONTH, "fips", "date"])
    write_partitioned(staged, path, MONTH, ["fips", "date"], replace, rebalance=False, drop=list(drop))


def features_of(staged: DataFrame, season_start: str, season_end: str) -> DataFrame:
    """Features from the monthly table: its months prune the scan, the days are tested below."""
    first, last = season_months(season_start, season_end)
    in_months = staged.filter(F.month(MONTH).between(first, last))
    return season_features(in_months, season_start, season_end)


def _write_features(features: DataFrame, path: str, replace: str, drop: Iterable[str] = ()) -> None:
    write_partitioned(features, path, "year", ["fips"], replace, drop=list(drop))


def store_weather(
    spark: SparkSession,
    raw: DataFrame,
    lake: Lake,
    season_start: str = SEASON_START,
    season_end: str = SEASON_END,
    raw_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Staged weather and season features as stored tables.

    With ``raw_path``, the folder of ``raw``, only what changed there since the
    last refresh is redone; a frame without a folder is staged in full.
    """
    staged_path, features_path = lake.staging(STAGED), lake.staging(FEATURES)
    ledger_path, season = lake.staging(LEDGER), f"{season_start}..{season_end}"
    for path in (staged_path, features_path, ledger_path):
        recover(spark, path)
    months: list | None = None  # None stands for all
    same_season = False
    seen = None
    if raw_path:
        write_table(raw_months(spark, raw_path), lake.staging(SEEN))
        seen = spark.read.schema(LEDGER_SCHEMA).parquet(lake.staging(SEEN))
        schema = seen.withColumn("season", F.lit(season)).schema
        ledger = table_or_none(spark, ledger_path, schema)
        if ledger is not None and is_committed(spark, staged_path):
            months = changed_months(seen, ledger)
            other = ledger.filter(F.col("season") != season).head(1)
            same_season = is_committed(spark, features_path) and not other
    if months is None or not same_season:
        remove_folder(spark, ledger_path)  # until both tables are whole again
    elif not months:
        return stored_weather(spark, lake)

    if months is None:
        _write_staged(raw, staged_path, REPLACE_TABLE)
    elif months:
        days = among(F.trunc("date", "month"), months)
        _write_staged(raw.filter(days), staged_path, REPLACE_PARTITIONS, [_folder(MONTH, m) for m in months])

    staged = read_table(spark, staged_path, STAGED_BY_MONTH)
    if months is None or not same_season:
        features = features_of(staged, season_start, season_end)
        _write_features(features, features_path, REPLACE_TABLE)
    else:
        years = {month and month.year for month in months}
        features = features_of(staged.filter(among(F.year(MONTH), years)), season_start, season_end)
        _write_features(features, features_path, REPLACE_PARTITIONS, [_folder("year", y) for y in years])
    if seen is not None:
        write_table(seen.withColumn("season", F.lit(season)), ledger_path)
    return stored_weather(spark, lake)


def refresh_fact(
    spark: SparkSession,
    staged: DataFrame,
    raw: DataFrame,
    lake: Lake,
    *,
    mode: str = FACT_WATERMARK,
    raw_path: str | None = None,
    placed: bool = False,
) -> None:
    """Bring ``fact_weather_daily`` up to date.

    ``watermark`` recomputes from the greatest day on and never touches earlier
    ones. ``changed`` replaces the days whose files in ``raw_path`` are new or
    changed since the fact last took them, wherever they lie; days that raw no
    longer holds stay, so windows loaded one after the other add up. ``full``
    makes the fact what raw is now. ``staged`` is the whole staged weather, read
    for a first or full build; the other modes stage the days they need. It is ``placed``
    where it comes in the fact's order (``stage_weather_in_order`` by ``FACT_ORDER``).
    """
    if mode not in (FACT_WATERMARK, FACT_CHANGED, FACT_FULL):
        raise ValueError(f"no such way to refresh the fact: {mode}")
    if mode == FACT_CHANGED and not raw_path:
        raise ValueError("changed days are told from the files of raw: raw_path is needed")
    path, ledger_path = lake.mart("fact_weather_daily"), lake.staging(FACT_DAYS)
    recover(spark, path)
    recover(spark, ledger_path)
    built = is_committed(spark, path)
    if built and mode == FACT_WATERMARK:
        # read through the view, the days prune the raw partitions and just they are deduplicated
        refresh_weather_fact(spark, stage_weather_in_order(raw, FACT_ORDER), path, placed=True)
        return
    seen = None
    if raw_path:
        write_table(raw_files(spark, raw_path, F.col("date")).withColumnRenamed("period", "date"), lake.staging(SEEN_DAYS))
        seen = spark.read.schema(DAYS_SCHEMA).parquet(lake.staging(SEEN_DAYS))
    ledger = table_or_none(spark, ledger_path, DAYS_SCHEMA) if built and mode == FACT_CHANGED else None
    columns = STAGED_WEATHER.names
    if not built or mode == FACT_FULL:
        write_partitioned(staged.select(*columns), path, "date", ["fips"], REPLACE_TABLE, rebalance=not placed)
    else:
        before = ledger if ledger is not None else seen.limit(0)
        write_table(changes(seen, before, "date").where("NOT gone"), lake.staging(CHANGED_DAYS))
        days = spark.read.schema("date date, gone boolean").parquet(lake.staging(CHANGED_DAYS))
        late = stage_weather_in_order(changed_days(raw, days), FACT_ORDER)
        write_partitioned(late.select(*columns), path, "date", ["fips"], REPLACE_PARTITIONS, rebalance=False)
    if seen is not None:
        write_table(seen, ledger_path)


def changed_days(raw: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the given days; the planner prunes the partitions of raw by them at run time."""
    return raw.join(days.where("date >= DATE'0001-01-01'").select("date"), "date", "left_semi")


def stored_weather(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    return (
        read_table(spark, lake.staging(STAGED), STAGED_WEATHER),
        read_table(spark, lake.staging(FEATURES), SEASON_FEATURES),
    )
