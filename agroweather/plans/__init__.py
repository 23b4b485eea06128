from agroweather.plans.analysis import state_yields, weather_yield_correlation
from agroweather.plans.catalog import (
    CHECKS,
    RULES,
    ChecksFailed,
    enforce_checks,
    quarantine,
    run_checks,
    with_rules,
)
from agroweather.plans.check_state import run_checks_by_period
from agroweather.plans.colocated import colocated_analysis, open_colocated, store_colocated
from agroweather.plans.features import season_features
from agroweather.plans.freshness import AgeLimits, StaleSource, enforce_freshness, source_freshness
from agroweather.plans.ingestion import (
    LoadReport,
    build_county_seed,
    county_seed,
    ingest_weather,
    ingest_yield,
    ingest_yield_if_new,
    request_batches,
)
from agroweather.plans.marts import (
    FACT_ORDER,
    calendar,
    commodity_dimension,
    county_dimension,
    crop_yield_fact,
    date_dimension,
    refresh_weather_fact,
    weather_yield_analysis,
)
from agroweather.plans.refresh import (
    FACT_CHANGED,
    FACT_FULL,
    FACT_WATERMARK,
    refresh_fact,
    store_weather,
    stored_weather,
)
from agroweather.plans.staging import stage_weather, stage_weather_in_order, stage_yields
from agroweather.plans.warehouse import (
    backfill,
    build_models,
    build_warehouse,
    open_models,
    register_views,
)

__all__ = [
    "AgeLimits",
    "CHECKS",
    "ChecksFailed",
    "FACT_CHANGED",
    "FACT_FULL",
    "FACT_ORDER",
    "FACT_WATERMARK",
    "LoadReport",
    "RULES",
    "StaleSource",
    "backfill",
    "build_county_seed",
    "build_models",
    "build_warehouse",
    "calendar",
    "colocated_analysis",
    "commodity_dimension",
    "county_dimension",
    "county_seed",
    "crop_yield_fact",
    "date_dimension",
    "enforce_checks",
    "enforce_freshness",
    "ingest_weather",
    "ingest_yield",
    "ingest_yield_if_new",
    "open_colocated",
    "open_models",
    "quarantine",
    "refresh_fact",
    "refresh_weather_fact",
    "register_views",
    "request_batches",
    "run_checks",
    "run_checks_by_period",
    "season_features",
    "source_freshness",
    "stage_weather",
    "stage_weather_in_order",
    "stage_yields",
    "state_yields",
    "store_colocated",
    "store_weather",
    "stored_weather",
    "weather_yield_analysis",
    "weather_yield_correlation",
    "with_rules",
]
