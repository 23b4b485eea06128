"""Stored staging: what a refresh redoes, what it leaves, and how it recovers."""

import os
import re
import shutil

import pytest

from agroweather import operators as op
from agroweather import plans
from agroweather.schemas import RAW_WEATHER
from agroweather.sources import Lake, read_table
from tests.conftest import day, rows, stamp


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path))


@pytest.fixture
def load(spark, raw_weather, lake):
    def run(days, replace="table"):
        """``days``: (date, maximum temperature, load hour) of one county."""
        made = [
            {"fips": "20011", "date": day(d), "temperature_2m_max": t, "temperature_2m_min": 10.0,
             "precipitation_sum": 1.0, "_ingested_at": stamp(hour)}
            for d, t, hour in days
        ]
        op.write_partitioned(raw_weather(*made), lake.raw("weather_daily"), "date", ["fips"], replace)

    return run


@pytest.fixture
def refresh(spark, lake):
    def run(*season):
        path = lake.raw("weather_daily")
        raw = read_table(spark, path, RAW_WEATHER)
        staged, features = plans.store_weather(spark, raw, lake, *season, raw_path=path)
        want = plans.stage_weather(raw)
        assert sorted(map(str, rows(staged))) == sorted(map(str, rows(want)))
        assert sorted(map(str, rows(features))) == sorted(
            map(str, rows(plans.season_features(want, *season))))
        return {
            f"{table}/{folder}": sorted(os.listdir(f"{lake.staging(table)}/{folder}"))
            for table in ("stg_weather_daily", "int_weather_growing_season")
            for folder in os.listdir(lake.staging(table)) if "=" in folder
        }

    return run


DAYS = [("2023-05-03", 21.0, 8), ("2024-04-29", 22.0, 8), ("2024-06-01", 23.0, 8), ("2024-12-31", 9.0, 8)]


def changed(before, after):
    return sorted(key for key in before.keys() | after.keys() if before.get(key) != after.get(key))


def test_only_changed_months_and_their_years_are_redone(load, refresh):
    load(DAYS)
    first = refresh()
    assert changed(first, refresh()) == []
    load([("2024-06-02", 25.0, 9)], "partitions")
    second = refresh()
    assert changed(first, second) == [
        "int_weather_growing_season/year=2024", "stg_weather_daily/month=2024-06-01"]
    load([("2024-12-31", 8.0, 9), ("2025-04-01", 20.0, 9)], "partitions")
    assert changed(second, refresh()) == [
        "int_weather_growing_season/year=2024", "int_weather_growing_season/year=2025",
        "stg_weather_daily/month=2024-12-01", "stg_weather_daily/month=2025-04-01"]


def test_replaced_window_and_other_season(load, refresh):
    load(DAYS)
    refresh()
    load([("2024-06-01", 30.0, 9), ("2026-07-01", 31.0, 9)])  # months are gone: in full
    assert {key for key in refresh() if "year" in key} == {
        f"int_weather_growing_season/year={year}" for year in (2024, 2026)}
    refresh("07-01", "07-31")
    assert refresh("08-01", "07-01").keys() == {
        "stg_weather_daily/month=2024-06-01", "stg_weather_daily/month=2026-07-01"}


def test_year_that_loses_its_season_days_leaves_the_features(load, refresh, lake):
    load([("2023-05-03", 21.0, 8), ("2024-04-01", 9.0, 8), ("2024-04-20", 22.0, 8)])
    refresh("04-15", "10-31")
    shutil.rmtree(f"{lake.raw('weather_daily')}/date=2024-04-20")
    assert "int_weather_growing_season/year=2024" not in refresh("04-15", "10-31")


def test_interrupted_refresh_is_redone(spark, load, refresh, lake):
    load(DAYS)
    refresh()
    os.remove(f"{lake.staging('stg_weather_daily')}/_SUCCESS")
    refresh()
    load([("2024-06-02", 25.0, 9)], "partitions")
    shutil.copytree(lake.staging("staged_months"), lake.staging("before"))
    refresh()
    # the ledger of before, and a month that an interrupted write has cleared
    shutil.rmtree(lake.staging("staged_months"))
    shutil.copytree(lake.staging("before"), lake.staging("staged_months"))
    shutil.rmtree(f"{lake.staging('stg_weather_daily')}/month=2024-06-01")
    refresh()


def test_frame_without_a_folder_is_staged_in_full(spark, raw_weather, load, refresh, lake):
    load(DAYS)
    refresh()
    other = raw_weather({"fips": "20013", "date": day("2024-06-01"), "temperature_2m_max": 1.0,
                         "temperature_2m_min": 1.0, "_ingested_at": stamp(8)})
    staged, features = plans.store_weather(spark, other, lake)
    assert staged.count() == features.count() == 1
    refresh()
    load([])
    refresh()


def test_season_months_prune_the_scan_of_the_features(spark, load, refresh, lake):
    load(DAYS)
    refresh()
    staged = read_table(spark, lake.staging("stg_weather_daily"), plans.refresh.STAGED_BY_MONTH)
    text = plans.refresh.features_of(staged, "04-01", "10-31")._jdf.queryExecution().executedPlan().toString()
    assert "month(month" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)


def test_watermark_comes_from_the_listing(spark, load, lake):
    load(DAYS)
    for folder, _, names in os.walk(lake.raw("weather_daily")):
        for name in names:
            if name.endswith(".parquet"):
                open(f"{folder}/{name}", "wb").write(b"no footer")
    assert op.high_watermark(spark, lake.raw("weather_daily")) == day("2024-12-31")
    load([])
    assert op.high_watermark(spark, lake.raw("weather_daily")) is None
