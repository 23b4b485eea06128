import os

import pytest
from pyspark.sql import functions as F

from agroweather import operators as op
from agroweather.plans import refresh_weather_fact
from agroweather.schemas import RAW_WEATHER, RAW_YIELD, STAGED_WEATHER
from agroweather.sources import read_table, table_or_none
from tests.conftest import day, rows, stamp


def partitions(path):
    return sorted(name for name in os.listdir(path) if "=" in name)


def files(path, partition):
    return [n for n in os.listdir(os.path.join(path, partition)) if n.endswith(".parquet")]


RECORDS = [
    {"fips": "19001", "date": day("2025-04-01"), "temperature_2m_max": 10.0, "_ingested_at": stamp(8)},
    {"fips": "17001", "date": day("2025-04-01"), "temperature_2m_max": 12.0, "_ingested_at": stamp(8)},
    {"fips": "19001", "date": day("2025-04-02"), "temperature_2m_max": 11.0, "_ingested_at": stamp(8)},
]


def test_bronze_has_one_file_per_partition_value(spark, raw_weather, tmp_path):
    path = str(tmp_path / "bronze")
    op.land_bronze(raw_weather(*RECORDS), path, "date")
    assert partitions(path) == ["date=2025-04-01", "date=2025-04-02"]
    assert all(len(files(path, p)) == 1 for p in partitions(path))
    back = read_table(spark, path, RAW_WEATHER)
    assert back.columns == RAW_WEATHER.names
    assert sorted(rows(back), key=str) == sorted(rows(raw_weather(*RECORDS)), key=str)


def test_bronze_replaces_the_prefix_and_empty_input_clears_it(spark, raw_weather, tmp_path):
    path = str(tmp_path / "bronze")
    op.land_bronze(raw_weather(*RECORDS), path, "date")
    op.land_bronze(raw_weather(RECORDS[2]), path, "date")
    assert partitions(path) == ["date=2025-04-02"]
    op.land_bronze(raw_weather(), path, "date")
    assert partitions(path) == []
    assert read_table(spark, path, RAW_WEATHER).isEmpty()


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_overwrite_mode_does_not_depend_on_the_session(spark, raw_yields, tmp_path, session_mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        for replace, want in (("table", [2024]), ("partitions", [2023, 2024, 2025])):
            path = str(tmp_path / replace)
            years = [{"year": y, "value_raw": "old"} for y in (2023, 2024, 2025)]
            op.write_partitioned(raw_yields(*years), path, "year", ["state_alpha"])
            op.write_partitioned(
                raw_yields({"year": 2024, "value_raw": "new"}), path, "year", [], replace
            )
            got = read_table(spark, path, RAW_YIELD).orderBy("year").collect()
            assert [r.year for r in got] == want
            assert [r.value_raw for r in got if r.year == 2024] == ["new"]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_null_partition_value_is_kept(spark, raw_yields, tmp_path):
    path = str(tmp_path / "raw")
    op.write_partitioned(raw_yields({"year": None}, {"year": 1999}), path, "year")
    assert {r.year for r in read_table(spark, path, RAW_YIELD).collect()} == {None, 1999}


def load(spark, bronze, raw, replace="table"):
    op.load_raw(spark, bronze, raw, RAW_WEATHER, partition_by="date", cluster_by=["fips"],
                replace=replace)


def test_raw_load_orders_rows_by_the_cluster_column(spark, raw_weather, tmp_path):
    bronze, raw = str(tmp_path / "b"), str(tmp_path / "r")
    op.land_bronze(raw_weather(*RECORDS), bronze, "date")
    load(spark, bronze, raw)
    stored = spark.read.parquet(f"{raw}/date=2025-04-01").collect()
    assert [r.fips for r in stored] == ["17001", "19001"]
    load(spark, bronze, raw)
    assert read_table(spark, raw, RAW_WEATHER).count() == 3


@pytest.mark.parametrize("column", ["fips", "date", "_ingested_at"])
def test_raw_load_refuses_missing_required_fields(spark, raw_weather, tmp_path, column):
    bronze, raw = str(tmp_path / "b"), str(tmp_path / "r")
    op.land_bronze(raw_weather(*RECORDS), bronze, "date")
    load(spark, bronze, raw)
    op.land_bronze(raw_weather({**RECORDS[0], column: None}), bronze, "date")
    with pytest.raises(op.RequiredFieldError, match=column):
        load(spark, bronze, raw)
    assert read_table(spark, raw, RAW_WEATHER).count() == 3


def test_raw_load_without_bronze_rows_leaves_raw_alone(spark, raw_weather, tmp_path):
    bronze, raw = str(tmp_path / "b"), str(tmp_path / "r")
    op.land_bronze(raw_weather(*RECORDS), bronze, "date")
    load(spark, bronze, raw)
    op.land_bronze(raw_weather(), bronze, "date")
    with pytest.raises(FileNotFoundError):
        load(spark, bronze, raw)
    assert read_table(spark, raw, RAW_WEATHER).count() == 3


def weather(fips, date, wind):
    return {"fips": fips, "date": day(date), "wind_speed_kmh": wind, "_ingested_at": stamp(8)}


def content(spark, path):
    table = read_table(spark, path, STAGED_WEATHER).orderBy("date", "fips")
    return [(str(r.date)[5:], r.fips, r.wind_speed_kmh) for r in table.collect()]


def test_incremental_fact(spark, staged_weather, tmp_path):
    path = str(tmp_path / "fact")
    first = [weather(f, d, 1.0) for d in ("2025-04-01", "2025-04-02", "2025-04-03") for f in "AB"]
    refresh_weather_fact(spark, staged_weather(*first), path)
    assert len(content(spark, path)) == 6

    second = staged_weather(
        weather("A", "2025-04-01", 2.0),
        weather("B", "2025-04-01", 1.0),
        weather("A", "2025-04-03", 2.0),
        weather("A", "2025-04-04", 2.0),
    )
    want = [
        ("04-01", "A", 1.0), ("04-01", "B", 1.0),
        ("04-02", "A", 1.0), ("04-02", "B", 1.0),
        ("04-03", "A", 2.0),
        ("04-04", "A", 2.0),
    ]
    for _ in range(2):
        refresh_weather_fact(spark, second, path)
        assert content(spark, path) == want


def test_incremental_fact_with_an_empty_target_stays_empty(spark, staged_weather, tmp_path):
    path = str(tmp_path / "fact")
    refresh_weather_fact(spark, staged_weather(), path)
    assert content(spark, path) == []
    refresh_weather_fact(spark, staged_weather(weather("A", "2025-04-01", 1.0)), path)
    assert content(spark, path) == []


def test_nothing_newer_changes_nothing(spark, staged_weather, tmp_path):
    path = str(tmp_path / "fact")
    refresh_weather_fact(spark, staged_weather(weather("A", "2025-04-02", 1.0)), path)
    refresh_weather_fact(spark, staged_weather(weather("A", "2025-04-01", 2.0)), path)
    assert content(spark, path) == [("04-02", "A", 1.0)]


@pytest.mark.parametrize("left", ["empty", "temporary"])
def test_interrupted_first_build_is_built_anew(spark, staged_weather, tmp_path, left):
    folder = tmp_path / "fact" / ("_temporary/0" if left == "temporary" else "")
    folder.mkdir(parents=True)
    path = str(tmp_path / "fact")
    refresh_weather_fact(spark, staged_weather(weather("A", "2025-04-01", 1.0)), path)
    assert content(spark, path) == [("04-01", "A", 1.0)]


def test_interrupted_load_does_not_count_as_loaded(spark, raw_yields, tmp_path):
    path = tmp_path / "raw"
    op.write_partitioned(raw_yields({"year": 2025}), str(path), "year", replace="partitions")
    assert op.year_is_loaded(spark, str(path), 2025) is True
    op.write_partitioned(raw_yields({"year": 2024}), str(path), "year", replace="partitions")
    assert op.year_is_loaded(spark, str(path), 2024) and op.year_is_loaded(spark, str(path), 2025)
    (path / "_SUCCESS").unlink()
    assert op.year_is_loaded(spark, str(path), 2025) is False


def test_year_probe(spark, raw_yields, tmp_path):
    path = str(tmp_path / "raw")
    assert op.year_is_loaded(spark, path, 2025) is False
    op.write_partitioned(raw_yields({"year": 2025}), path, "year")
    assert op.year_is_loaded(spark, path, 2025) is True
    assert op.year_is_loaded(spark, path, 2024) is False
    assert table_or_none(spark, str(tmp_path / "none"), RAW_YIELD) is None


def test_count_gate(spark, raw_yields):
    made = [{"state_alpha": s} for s, n in (("IA", 2), ("IL", 3), ("IN", 4)) for _ in range(n)]
    states = spark.createDataFrame([(s,) for s in ("IA", "IL", "IN", "NE")], "state_alpha string")
    work = op.work_list(states, ["CORN", "SOYBEANS"], [2025])
    counts = op.record_counts(raw_yields(*made), work, limit=3)
    got = {(r.commodity_desc, r.state_alpha): (r.n_records, r.over_limit) for r in counts.collect()}
    assert len(got) == 8
    assert got["CORN", "IA"] == (2, False)
    assert got["CORN", "IL"] == (3, True)
    assert got["CORN", "IN"] == (4, True)
    assert got["SOYBEANS", "NE"] == (0, False)
    with pytest.raises(op.RecordLimitExceeded, match="4 records for CORN/IN/2025"):
        op.enforce_record_limit(counts)
    op.enforce_record_limit(counts.filter(~F.col("over_limit")))
