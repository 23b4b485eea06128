"""Checks kept by period: equal to a full run, and only changed periods are counted anew."""

import os
import re
import shutil
from dataclasses import replace

import pytest

from agroweather import operators as op
from agroweather import plans
from agroweather.operators import publish
from agroweather.plans import check_state
from agroweather.schemas import COUNTY_CENTROIDS, STAGED_WEATHER
from agroweather.sources import Lake, read_table
from tests.conftest import day, rows, stamp

COUNTIES = [("20011", "KS", "Bourbon", 37.8, -94.8), ("20013", "KS", "Brown", 39.8, -95.5)]


class Warehouse:
    def __init__(self, spark, root, raw_weather, raw_yields):
        self.spark, self.lake = spark, Lake(root)
        self.raw_weather, self.raw_yields = raw_weather, raw_yields
        self.counties = spark.createDataFrame(COUNTIES, COUNTY_CENTROIDS)

    def load(self, days, replace="partitions"):
        """``days``: (county, date, maximum temperature)."""
        made = [
            {"fips": f, "date": day(d), "temperature_2m_max": t, "temperature_2m_min": 10.0,
             "precipitation_sum": 1.0, "et0_fao_evapotranspiration": 1.0,
             "shortwave_radiation_sum": 1.0, "_ingested_at": stamp(8)}
            for f, d, t in days
        ]
        op.write_partitioned(
            self.raw_weather(*made), self.lake.raw("weather_daily"), "date", ["fips"], replace)

    def load_yields(self, *records):
        op.write_partitioned(
            self.raw_yields(*records), self.lake.raw("nass_yield"), "year", ["state_alpha"], "partitions")

    def build(self):
        return plans.build_warehouse(self.spark, self.lake, self.counties, fact_mode="changed")

    def check(self, models, checks=None):
        """The results, which equal those of a full run, and the periods counted anew."""
        before = self.files()
        got = rows(plans.run_checks_by_period(self.spark, self.lake, models, checks))
        assert sorted(got) == sorted(rows(plans.run_checks(models, checks)))
        after = self.files()
        return (
            {row[:3]: row[3] for row in got if row[3]},
            sorted(key for key in before.keys() | after.keys() if before.get(key) != after.get(key)),
        )

    def files(self):
        root = self.lake.path("checks", "").rstrip("/")
        return {
            f"{name}/{folder.removeprefix('period=')}": sorted(os.listdir(f"{root}/{name}/{folder}"))
            for name in (os.listdir(root) if os.path.isdir(root) else [])
            for folder in os.listdir(f"{root}/{name}") if folder.startswith("period=")
        }


@pytest.fixture
def warehouse(spark, tmp_path, raw_weather, raw_yields):
    made = Warehouse(spark, str(tmp_path), raw_weather, raw_yields)
    made.load([("20011", "2023-05-03", 21.0), ("20013", "2024-05-04", None), ("99999", "2024-07-01", 30.0)])
    made.load_yields(
        {"state_fips_code": "20", "county_code": "011", "year": 2023},
        {"state_fips_code": "20", "county_code": "011", "year": 2024},
        {"state_fips_code": "20", "county_code": "011", "year": 2024, "value_raw": "150"},
    )
    return made


def test_only_changed_periods_are_counted(warehouse):
    failing, counted = warehouse.check(models := warehouse.build())
    assert failing[("fact_weather_daily", "relationships", "fips")] == 1
    assert failing[("stg_weather_daily", "not_null", "temperature_2m_max")] == 1
    assert failing[("fact_crop_yield", "unique_combination", "fips,commodity,year")] == 1
    assert {key for key in counted if "daily" in key} == {
        f"{name}/{month}" for name in ("fact_weather_daily", "stg_weather_daily")
        for month in ("2023-05-01", "2024-05-01", "2024-07-01")}
    assert warehouse.check(models) == (failing, [])

    warehouse.load([("20011", "2024-07-02", None), ("88888", "2024-07-02", 30.0)])
    failing, counted = warehouse.check(warehouse.build())
    assert failing[("fact_weather_daily", "relationships", "fips")] == 2
    assert failing[("fact_weather_daily", "not_null", "temperature_2m_max")] == 2
    assert [key for key in counted if "daily" in key] == [
        "fact_weather_daily/2024-07-01", "stg_weather_daily/2024-07-01"]
    assert "int_weather_growing_season/2024" in counted
    assert "int_weather_growing_season/2023" not in counted
    assert not [key for key in counted if key.startswith("stg_nass_yield")]


@pytest.fixture
def fact(spark, warehouse, staged_weather):
    """The fact alone: ``load`` replaces its days, ``models`` are it and its parent."""
    checks = {"fact_weather_daily": plans.CHECKS["fact_weather_daily"]}

    def load(*days):
        made = [
            {"fips": f, "date": day(d), "temperature_2m_max": t, "temperature_2m_min": 10.0,
             "precipitation_sum": 1.0, "_ingested_at": stamp(8)} for f, d, t in days
        ]
        path = warehouse.lake.mart("fact_weather_daily")
        op.write_partitioned(staged_weather(*made), path, "date", ["fips"], "partitions")
        return {"fact_weather_daily": read_table(spark, path, STAGED_WEATHER), "dim_county": warehouse.counties}

    return load, checks


FACT_DAYS = [("20011", "2023-05-03", 21.0), ("20013", "2024-05-04", None), ("99999", "2024-07-01", 30.0)]
ORPHANS = ("fact_weather_daily", "relationships", "fips")
NULLS = ("fact_weather_daily", "not_null", "temperature_2m_max")


def test_a_changed_parent_needs_no_scan(spark, warehouse, fact):
    load, checks = fact
    models = load(*FACT_DAYS)
    assert warehouse.check(models, checks)[0] == {ORPHANS: 1, NULLS: 1}
    models["dim_county"] = models["dim_county"].limit(0)
    assert warehouse.check(models, checks) == ({ORPHANS: 3, NULLS: 1}, [])


def test_periods_that_go_and_other_checks(warehouse, fact):
    load, checks = fact
    models = load(*FACT_DAYS)
    warehouse.check(models, checks)
    shutil.rmtree(f"{warehouse.lake.mart('fact_weather_daily')}/date=2024-05-04")
    models = load(("20011", "2024-07-01", 20.0))
    assert warehouse.check(models, checks) == (
        {}, ["fact_weather_daily/2024-05-01", "fact_weather_daily/2024-07-01"])
    ruled = {"fact_weather_daily": replace(
        checks["fact_weather_daily"], holds={"mild": "temperature_2m_max < 21"})}
    assert warehouse.check(models, ruled) == (
        {("fact_weather_daily", "holds", "mild"): 1},
        ["fact_weather_daily/2023-05-01", "fact_weather_daily/2024-07-01"])


def test_interrupted_refresh_is_redone(spark, warehouse, fact, monkeypatch):
    load, checks = fact
    warehouse.check(load(*FACT_DAYS), checks)
    models = load(("20011", "2024-07-02", None), ("20011", "2025-01-01", None))
    real = publish.move

    def cut(session, source, target):
        if "/checks/fact_weather_daily/" in target:
            raise KeyboardInterrupt
        real(session, source, target)

    monkeypatch.setattr(publish, "move", cut)
    with pytest.raises(KeyboardInterrupt):
        plans.run_checks_by_period(spark, warehouse.lake, models, checks)
    monkeypatch.undo()
    assert warehouse.check(models, checks)[0] == {ORPHANS: 1, NULLS: 3}


def test_periods_prune_the_scan(spark, warehouse, fact):
    models = fact[0](*FACT_DAYS)
    stored = check_state.stored_models(spark, warehouse.lake, models)["fact_weather_daily"]
    some = stored.rows.where(check_state.among(stored.period, ["2024-07-01", "2023-01-01"]))
    text = some._jdf.queryExecution().executedPlan().toString()
    assert " IN (2024-07-01,2023-01-01)" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert some.count() == 1


def test_lazy_views_have_no_periods(spark, warehouse, fact):
    models = {**fact[0](*FACT_DAYS), "stg_weather_daily": None}
    assert set(check_state.stored_models(spark, warehouse.lake, models)) == {"fact_weather_daily"}
