from agroweather.sources.counties import read_centroids, read_gazetteer
from agroweather.sources.lake import Lake, read_table, table_or_none
from agroweather.sources.weather_payload import (
    attach_points,
    landed_keys,
    parse_weather_payloads,
    read_payloads,
)
from agroweather.sources.yield_payload import in_scope, parse_yield_payloads

__all__ = [
    "Lake",
    "attach_points",
    "in_scope",
    "landed_keys",
    "parse_weather_payloads",
    "parse_yield_payloads",
    "read_centroids",
    "read_gazetteer",
    "read_payloads",
    "read_table",
    "table_or_none",
]
