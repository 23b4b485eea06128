"""Build every model from raw, in dependency order."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroweather.functions.calendar import SEASON_END, SEASON_START
from agroweather.operators.publish import REPLACE_TABLE
from agroweather.operators.sinks import write_partitioned, write_table
from agroweather.plans.catalog import run_checks
from agroweather.plans.features import season_features
from agroweather.plans.ingestion import (
    TARGET_YEAR,
    WEATHER_TABLE,
    WINDOW_END,
    WINDOW_START,
    YIELD_TABLE,
    LoadReport,
    ingest_weather,
    ingest_yield,
)
from agroweather.plans.marts import (
    CALENDAR_END,
    CALENDAR_START,
    commodity_dimension,
    county_dimension,
    crop_yield_fact,
    date_dimension,
    weather_yield_analysis,
)
from agroweather.plans.refresh import FACT_WATERMARK, refresh_fact, store_weather, stored_weather
from agroweather.plans.staging import stage_weather, stage_yields
from agroweather.schemas import (
    ANALYSIS,
    COUNTY_CENTROIDS,
    CROP_YIELD,
    DIM_COMMODITY,
    DIM_DATE,
    RAW_WEATHER,
    RAW_YIELD,
    STAGED_WEATHER,
)
from agroweather.sources.lake import Lake, read_table

MART_CLUSTERING = ["state_alpha", "commodity"]
# One row beside the staging tables: the options of the last finished build.
OPTIONS = "build_options"
OPTIONS_SCHEMA = T.StructType(
    [
        T.StructField("season_start", T.StringType()),
        T.StructField("season_end", T.StringType()),
        T.StructField("store_staging", T.BooleanType()),
    ]
)


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    write_table(df, path)
    return read_table(spark, path, df.schema)


def build_models(
    spark: SparkSession,
    raw_weather: DataFrame,
    raw_yields: DataFrame,
    centroids: DataFrame,
    lake: Lake,
    *,
    season_start: str = SEASON_START,
    season_end: str = SEASON_END,
    calendar_start: date = CALENDAR_START,
    calendar_end: date = CALENDAR_END,
    store_staging: bool = True,
    raw_weather_path: str | None = None,
    fact_mode: str = FACT_WATERMARK,
) -> dict[str, DataFrame]:
    """Write the marts under the lake root and return every model by name.

    The deduplicated weather feeds the fact, the features and the checks, and
    the features feed the mart and the checks. Both are stored so that the
    full-table shuffle behind them runs once; where ``raw_weather`` is the table
    in the folder ``raw_weather_path``, a later build redoes only the months and
    years whose files changed. With ``store_staging=False`` both stay lazy views,
    as the staged yields (a per-row projection) always do. ``fact_mode`` is that of
    :func:`refresh_fact`.
    """
    options = F.struct(
        F.lit(season_start).alias("season_start"),
        F.lit(season_end).alias("season_end"),
        F.lit(store_staging).alias("store_staging"),
    )
    staged_yields = stage_yields(raw_yields)
    if store_staging:
        staged_weather, features = store_weather(
            spark, raw_weather, lake, season_start, season_end, raw_weather_path
        )
    else:
        staged_weather = stage_weather(raw_weather)
        features = season_features(staged_weather, season_start, season_end)

    counties = _stored(spark, county_dimension(centroids), lake.mart("dim_county"))
    commodities = _stored(spark, commodity_dimension(spark), lake.mart("dim_commodity"))
    dates = _stored(
        spark,
        date_dimension(spark, calendar_start, calendar_end, season_start, season_end),
        lake.mart("dim_date"),
    )

    fact_path = lake.mart("fact_weather_daily")
    refresh_fact(spark, staged_weather, raw_weather, lake, mode=fact_mode, raw_path=raw_weather_path)

    yield_path = lake.mart("fact_crop_yield")
    write_partitioned(crop_yield_fact(staged_yields), yield_path, "year", MART_CLUSTERING)
    crop_yields = read_table(spark, yield_path, CROP_YIELD)

    analysis_path = lake.mart("weather_yield_analysis")
    write_partitioned(
        weather_yield_analysis(crop_yields, features, counties),
        analysis_path,
        "year",
        MART_CLUSTERING,
    )
    _stored(spark, spark.range(1).select(options.alias("o")).select("o.*"), lake.staging(OPTIONS))
    return {
        "stg_weather_daily": staged_weather,
        "stg_nass_yield": staged_yields,
        "int_weather_growing_season": features,
        "dim_county": counties,
        "dim_commodity": commodities,
        "dim_date": dates,
        "fact_weather_daily": read_table(spark, fact_path, STAGED_WEATHER),
        "fact_crop_yield": crop_yields,
        "weather_yield_analysis": read_table(spark, analysis_path, ANALYSIS),
    }


def build_warehouse(
    spark: SparkSession, lake: Lake, centroids: DataFrame, **options
) -> dict[str, DataFrame]:
    """:func:`build_models` over the raw tables of the lake."""
    return build_models(
        spark,
        read_table(spark, lake.raw(WEATHER_TABLE), RAW_WEATHER),
        read_table(spark, lake.raw(YIELD_TABLE), RAW_YIELD),
        centroids,
        lake,
        raw_weather_path=lake.raw(WEATHER_TABLE),
        **options,
    )


def open_models(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The models of a lake built before, for a new session.

    Season and ``store_staging`` are those of the last build: where it stored
    the staged weather and the features they are read, else they are lazy views.
    """
    built = read_table(spark, lake.staging(OPTIONS), OPTIONS_SCHEMA).head()
    marts = {
        "dim_county": COUNTY_CENTROIDS,
        "dim_commodity": DIM_COMMODITY,
        "dim_date": DIM_DATE,
        "fact_weather_daily": STAGED_WEATHER,
        "fact_crop_yield": CROP_YIELD,
        "weather_yield_analysis": ANALYSIS,
    }
    if built.store_staging:
        staged_weather, features = stored_weather(spark, lake)
    else:
        staged_weather = stage_weather(read_table(spark, lake.raw(WEATHER_TABLE), RAW_WEATHER))
        features = season_features(staged_weather, built.season_start, built.season_end)
    return {
        "stg_weather_daily": staged_weather,
        "stg_nass_yield": stage_yields(read_table(spark, lake.raw(YIELD_TABLE), RAW_YIELD)),
        "int_weather_growing_season": features,
        **{name: read_table(spark, lake.mart(name), schema) for name, schema in marts.items()},
    }


def register_views(models: dict[str, DataFrame]) -> None:
    """Expose the models to SQL as temporary views of the same names."""
    for name, model in models.items():
        model.createOrReplaceTempView(name)


def backfill(
    spark: SparkSession,
    lake: Lake,
    *,
    weather_payloads: str,
    yield_payloads: str,
    points: DataFrame,
    weather_start: date = WINDOW_START,
    weather_end: date = WINDOW_END,
    year: int = TARGET_YEAR,
    replace: str = REPLACE_TABLE,
    weather_options: dict | None = None,
    yield_options: dict | None = None,
    build_options: dict | None = None,
) -> tuple[dict[str, LoadReport], dict[str, DataFrame], DataFrame]:
    """Re-run both ingestions for a window and a year, rebuild the models, then check them.

    By default raw then holds this window only; ``replace="partitions"`` keeps
    the days and years of earlier windows. The fact takes days before its
    greatest one only with ``build_options={"fact_mode": "changed"}`` (or
    ``"full"``), which a window loaded late needs. The payloads are folders of landed
    responses, ``points`` is the centroid table.
    Returns the load reports, the models, and the check results.
    """
    reports = {
        WEATHER_TABLE: ingest_weather(
            spark,
            weather_payloads,
            points,
            lake,
            start=weather_start,
            end=weather_end,
            replace=replace,
            **(weather_options or {}),
        ),
        YIELD_TABLE: ingest_yield(
            spark, yield_payloads, lake, year=year, replace=replace, **(yield_options or {})
        ),
    }
    models = build_warehouse(spark, lake, points, **(build_options or {}))
    return reports, models, run_checks(models)
