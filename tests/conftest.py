import os
import sys
from datetime import date, datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from agroweather.schemas import RAW_WEATHER, RAW_YIELD, STAGED_WEATHER
from agroweather.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        initial_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": "4",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def stamp(hour: int, day: int = 1) -> datetime:
    return datetime(2026, 1, day, hour, tzinfo=timezone.utc)


def day(text: str) -> date:
    return date.fromisoformat(text)


@pytest.fixture
def raw_weather(spark):
    def build(*rows):
        """Rows are dicts; columns left out are NULL."""
        return spark.createDataFrame(
            [tuple(row.get(name) for name in RAW_WEATHER.names) for row in rows],
            _nullable(RAW_WEATHER),
        )

    return build


@pytest.fixture
def staged_weather(spark):
    def build(*rows):
        return spark.createDataFrame(
            [tuple(row.get(name) for name in STAGED_WEATHER.names) for row in rows],
            STAGED_WEATHER,
        )

    return build


@pytest.fixture
def raw_yields(spark):
    defaults = {
        "state_alpha": "NE",
        "state_fips_code": "31",
        "county_code": "055",
        "county_name": "DOUGLAS",
        "commodity_desc": "CORN",
        "statisticcat_desc": "YIELD",
        "agg_level_desc": "COUNTY",
        "short_desc": "",
        "unit_desc": "BU / ACRE",
        "year": 2025,
        "value_raw": "160.0",
        "_ingested_at": stamp(8),
    }

    def build(*rows):
        return spark.createDataFrame(
            [tuple({**defaults, **row}[name] for name in RAW_YIELD.names) for row in rows],
            _nullable(RAW_YIELD),
        )

    return build


def _nullable(schema):
    from pyspark.sql.types import StructField, StructType

    return StructType([StructField(f.name, f.dataType, True) for f in schema])


def rows(df):
    return [tuple(row) for row in df.collect()]
