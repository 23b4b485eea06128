"""Tables published by renames: cut off at every step, then written or read again."""

import os

import pytest
from pyspark.sql import functions as F

from agroweather import operators as op
from agroweather import plans
from agroweather.operators import publish, sinks
from agroweather.plans import refresh
from agroweather.schemas import RAW_WEATHER, STAGED_WEATHER
from agroweather.sources import Lake, read_table
from tests.conftest import day, stamp


class Cut(Exception):
    """The driver is gone."""


@pytest.fixture
def cut_before(monkeypatch):
    """Stop at the n-th rename from now on; ``None`` lets all pass."""
    real, left = publish.move, {"n": None}

    def move(spark, source, target):
        if left["n"] is not None:
            if not left["n"]:
                raise Cut(target)
            left["n"] -= 1
        real(spark, source, target)

    monkeypatch.setattr(publish, "move", move)
    return lambda n: left.update(n=n)


def weather(fips, date, wind):
    return {"fips": fips, "date": day(date), "wind_speed_kmh": wind, "_ingested_at": stamp(8)}


def content(spark, path):
    found = read_table(spark, path, STAGED_WEATHER).orderBy("date").collect()
    return [(r.date.day, r.wind_speed_kmh) for r in found]


def days(staged_weather, first, last, wind):
    return staged_weather(*[weather("A", f"2025-04-{d:02}", wind) for d in range(first, last + 1)])


# renames of a refresh: the record, then the days 3, 4, 5 and 6
@pytest.mark.parametrize("renames", range(6))
def test_cut_refresh_is_finished_by_the_next(spark, staged_weather, tmp_path, cut_before, renames):
    path = str(tmp_path / "fact")
    plans.refresh_weather_fact(spark, days(staged_weather, 1, 3, 1.0), path)
    cut_before(renames)
    later = days(staged_weather, 1, 6, 2.0)
    if renames < 5:
        with pytest.raises(Cut):
            plans.refresh_weather_fact(spark, later, path)
    else:
        plans.refresh_weather_fact(spark, later, path)
    cut_before(None)
    plans.refresh_weather_fact(spark, later, path)
    assert content(spark, path) == [(1, 1.0), (2, 1.0), (3, 2.0), (4, 2.0), (5, 2.0), (6, 2.0)]
    assert not os.path.exists(publish.work_folder(path))


def test_cut_between_delete_and_rename(spark, staged_weather, tmp_path, cut_before):
    """Only the last day was moved, as in an overwrite that goes through its days in any order."""
    path = str(tmp_path / "fact")
    plans.refresh_weather_fact(spark, days(staged_weather, 1, 3, 1.0), path)
    sinks.write_beside(days(staged_weather, 3, 6, 2.0), path, "date")
    publish.decide(spark, path, "partitions")
    publish.move(spark, f"{publish.incoming(path)}/date=2025-04-06", f"{path}/date=2025-04-06")
    plans.refresh_weather_fact(spark, days(staged_weather, 6, 7, 3.0), path)
    assert content(spark, path) == [(1, 1.0), (2, 1.0), (3, 2.0), (4, 2.0), (5, 2.0), (6, 3.0), (7, 3.0)]


def test_undecided_write_leaves_the_table_alone(spark, staged_weather, tmp_path):
    path = str(tmp_path / "fact")
    plans.refresh_weather_fact(spark, days(staged_weather, 1, 3, 1.0), path)
    sinks.write_beside(days(staged_weather, 2, 6, 2.0), path, "date")
    assert content(spark, path) == [(1, 1.0), (2, 1.0), (3, 1.0)]
    assert op.recover(spark, path) is False
    assert not os.path.exists(publish.work_folder(path))
    assert content(spark, path) == [(1, 1.0), (2, 1.0), (3, 1.0)]


# the record, the old table out of the way, the new one in
@pytest.mark.parametrize("renames", range(3))
def test_cut_swap_of_a_whole_table(spark, staged_weather, tmp_path, cut_before, renames):
    path = str(tmp_path / "table")
    op.write_partitioned(days(staged_weather, 1, 2, 1.0), path, "date")
    cut_before(renames)
    with pytest.raises(Cut):
        op.write_partitioned(days(staged_weather, 5, 5, 2.0), path, "date")
    cut_before(None)
    op.recover(spark, path)
    assert content(spark, path) == ([(1, 1.0), (2, 1.0)] if renames == 0 else [(5, 2.0)])
    assert op.recover(spark, path) is False


def test_dropped_partitions_go_unless_written(spark, staged_weather, tmp_path):
    path = str(tmp_path / "table")
    op.write_partitioned(days(staged_weather, 1, 4, 1.0), path, "date")
    gone = ["date=2025-04-02", "date=2025-04-03", "date=2025-04-09"]
    op.write_partitioned(days(staged_weather, 3, 3, 2.0), path, "date", (), "partitions", drop=gone)
    assert content(spark, path) == [(1, 1.0), (3, 2.0), (4, 1.0)]


def raw_load(spark, root, **options):
    return op.load_raw(spark, f"{root}/b", f"{root}/raw", RAW_WEATHER, partition_by="date", cluster_by=["fips"], **options)


def test_raw_load_reads_bronze_once(spark, raw_weather, tmp_path, monkeypatch):
    op.land_bronze(raw_weather(weather("A", "2025-04-01", 1.0), weather("B", "2025-04-02", 1.0)), f"{tmp_path}/b", "date")
    reads = []
    real = sinks.read_table
    monkeypatch.setattr(sinks, "read_table", lambda *args: reads.append(args[1]) or real(*args))
    monkeypatch.setattr(sinks, "require_not_null", None)
    assert raw_load(spark, tmp_path) == 2
    assert reads == [f"{tmp_path}/b"]


@pytest.mark.parametrize("column", ["fips", "_ingested_at"])
def test_failing_gate_discards_what_it_wrote(spark, raw_weather, tmp_path, column):
    good = weather("A", "2025-04-01", 1.0)
    op.land_bronze(raw_weather(good), f"{tmp_path}/b", "date")
    raw_load(spark, tmp_path)
    before = sorted(os.listdir(f"{tmp_path}/raw/date=2025-04-01"))
    op.land_bronze(raw_weather(good, {**good, column: None}), f"{tmp_path}/b", "date")
    with pytest.raises(op.RequiredFieldError, match=column):
        raw_load(spark, tmp_path)
    assert sorted(os.listdir(f"{tmp_path}/raw/date=2025-04-01")) == before
    assert not os.path.exists(f"{tmp_path}/_publish-raw")


def test_load_cut_after_its_gate_counts_as_loaded(spark, raw_yields, tmp_path, cut_before):
    path = str(tmp_path / "raw")
    op.write_partitioned(raw_yields({"year": 2024}), path, "year")
    cut_before(1)
    with pytest.raises(Cut):
        op.write_partitioned(raw_yields({"year": 2025}), path, "year", (), "partitions")
    cut_before(None)
    assert op.year_is_loaded(spark, path, 2025) and op.year_is_loaded(spark, path, 2024)


# ---- late windows and full refreshes of the fact


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path))


@pytest.fixture
def window(spark, raw_weather, lake):
    def run(rows, replace="partitions", mode="changed"):
        path = lake.raw("weather_daily")
        made = [{"fips": "A", "date": day(d), "temperature_2m_max": t, "_ingested_at": stamp(8)} for d, t in rows]
        op.write_partitioned(raw_weather(*made), path, "date", ["fips"], replace)
        raw = read_table(spark, path, RAW_WEATHER)
        plans.refresh_fact(spark, plans.stage_weather(raw), raw, lake, mode=mode, raw_path=path)
        fact = lake.mart("fact_weather_daily")
        files = {d: sorted(os.listdir(f"{fact}/{d}")) for d in os.listdir(fact) if "=" in d}
        found = read_table(spark, fact, STAGED_WEATHER).orderBy("date").collect()
        return [(str(r.date), r.temperature_2m_max) for r in found], files

    return run


def test_late_window_needs_the_changed_mode(window):
    window([("1998-05-01", 1.0), ("1998-05-02", 1.0)])
    assert window([("1996-05-01", 2.0)], mode="watermark")[0] == [("1998-05-01", 1.0), ("1998-05-02", 1.0)]
    found, files = window([("1997-05-01", 3.0)])
    assert found == [("1996-05-01", 2.0), ("1997-05-01", 3.0), ("1998-05-01", 1.0), ("1998-05-02", 1.0)]
    again, same = window([("1996-05-01", 4.0)])
    assert [row for row in again if row not in found] == [("1996-05-01", 4.0)]
    assert {d for d in files if files[d] != same[d]} == {"date=1996-05-01"}


def test_windows_that_raw_no_longer_holds_stay(window):
    window([("1998-05-01", 1.0)], "table")
    assert window([("1996-05-01", 2.0)], "table")[0] == [("1996-05-01", 2.0), ("1998-05-01", 1.0)]
    assert window([("1996-05-01", 3.0)], "table", "full")[0] == [("1996-05-01", 3.0)]
    assert window([("1995-05-01", 4.0)], "table")[0] == [("1995-05-01", 4.0), ("1996-05-01", 3.0)]


def test_interrupted_changed_refresh_is_redone(spark, window, cut_before):
    window([("1998-05-01", 1.0), ("1998-05-02", 1.0)])
    for renames in (1, 4, 5, 6, 7, 8):
        cut_before(renames)
        try:
            window([("1996-05-01", float(renames)), ("1996-05-02", 2.0)])
        except Cut:
            pass
        cut_before(None)
        assert window([("1997-05-01", 3.0)])[0] == [
            ("1996-05-01", float(renames)), ("1996-05-02", 2.0), ("1997-05-01", 3.0),
            ("1998-05-01", 1.0), ("1998-05-02", 1.0)]


def test_changed_days_prune_the_scan_of_raw(spark, window, lake):
    window([("1996-05-01", 1.0), ("1998-05-01", 1.0)])
    raw = read_table(spark, lake.raw("weather_daily"), RAW_WEATHER)
    days = spark.read.schema("date date, files long").parquet(lake.staging(refresh.SEEN_DAYS))
    plan = plans.stage_weather(refresh.changed_days(raw, days))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_unknown_modes_are_refused(spark, lake, staged_weather, raw_weather):
    for options in ({"mode": "some"}, {"mode": "changed"}):
        with pytest.raises(ValueError):
            plans.refresh_fact(spark, staged_weather(), raw_weather(), lake, **options)


def test_far_off_months_leave_those_between_alone(spark, raw_weather, lake):
    path = lake.raw("weather_daily")

    def load(rows, replace="partitions"):
        made = [{"fips": "A", "date": day(d), "temperature_2m_max": t, "temperature_2m_min": 1.0,
                 "_ingested_at": stamp(8)} for d, t in rows]
        op.write_partitioned(raw_weather(*made), path, "date", ["fips"], replace)
        raw = read_table(spark, path, RAW_WEATHER)
        staged, features = plans.store_weather(spark, raw, lake, raw_path=path)
        assert sorted(map(str, staged.collect())) == sorted(map(str, plans.stage_weather(raw).collect()))
        assert sorted(map(str, features.collect())) == sorted(
            map(str, plans.season_features(plans.stage_weather(raw)).collect()))
        return {
            f"{table}/{folder}": sorted(os.listdir(f"{lake.staging(table)}/{folder}"))
            for table in (refresh.STAGED, refresh.FEATURES)
            for folder in os.listdir(lake.staging(table)) if "=" in folder
        }

    first = load([(f"{y}-{m:02}-15", 20.0) for y in range(2005, 2010) for m in (4, 6)], "table")
    second = load([("2005-06-15", 25.0), ("2009-06-15", 25.0)])
    assert {key for key in first if first[key] != second[key]} == {
        f"{refresh.STAGED}/month=2005-06-01", f"{refresh.STAGED}/month=2009-06-01",
        f"{refresh.FEATURES}/year=2005", f"{refresh.FEATURES}/year=2009"}


def test_load_log(spark, raw_weather, tmp_path):
    def load(hour, **options):
        op.land_bronze(raw_weather({**weather("A", "2025-04-01", 1.0), "_ingested_at": stamp(hour)}), f"{tmp_path}/b", "date")
        raw_load(spark, tmp_path, log_path=f"{tmp_path}/log", **options)
        return spark.read.parquet(f"{tmp_path}/log").agg(F.max("latest"), F.count("*")).head()

    assert load(8)[1] == 1
    assert load(6)[1] == 1
    assert load(9, replace="partitions")[1] == 2
