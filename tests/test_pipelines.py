import json

import pytest

from agroweather import operators as op
from agroweather import plans
from agroweather.schemas import RAW_WEATHER, RAW_YIELD, STAGED_WEATHER
from agroweather.sources import Lake, read_table
from tests.conftest import day, rows, stamp
from tests.test_sources import RECORD

VARIABLES = [f for f in RAW_WEATHER.names if f not in
             ("fips", "latitude", "longitude", "date", "_ingested_at")]


@pytest.fixture
def centroids(spark):
    return spark.createDataFrame(
        [("31055", "NE", "Douglas County", 41.0, -94.0), ("31057", "NE", "Dixon County", 41.1, -94.1)],
        "fips string, state_alpha string, county_name string, lat double, lon double",
    )


def weather_body(times, value):
    daily = {"time": times, **{name: [value] * len(times) for name in VARIABLES}}
    blocks = [{"latitude": 41.0, "longitude": -94.0, "daily": daily},
              {"latitude": 41.1, "longitude": -94.1, "daily": daily}]
    return json.dumps(blocks)


@pytest.fixture
def responses(tmp_path_factory):
    def land(*bodies, key=True):
        """One file per response, below its batch folder where there is one."""
        root = tmp_path_factory.mktemp("landed")
        for i, body in enumerate(bodies):
            folder = root / f"batch_id={i}" if key else root
            folder.mkdir(exist_ok=True)
            (folder / f"r{i}.json").write_text(body)
        return str(root)

    return land


def yield_body(*changes):
    return json.dumps({"data": [{**RECORD, "commodity_desc": "CORN", **change} for change in changes]})


APRIL = ["2025-04-01", "2025-04-02", "2025-04-03"]


def test_weather_ingestion(spark, centroids, responses, tmp_path):
    lake = Lake(str(tmp_path))
    report = plans.ingest_weather(
        spark, responses(weather_body(APRIL, 20.0)), centroids, lake,
        start=day("2025-04-01"), end=day("2025-04-02"), ingested_at=stamp(8),
    )
    assert (report.status, report.rows) == ("loaded", 4)
    raw = read_table(spark, lake.raw("weather_daily"), RAW_WEATHER)
    assert {r._ingested_at for r in raw.collect()} == {stamp(8).replace(tzinfo=None)}
    assert {(r.fips, r.date.day) for r in raw.collect()} == {
        ("31055", 1), ("31055", 2), ("31057", 1), ("31057", 2)}
    bronze = read_table(spark, lake.bronze("weather_daily"), RAW_WEATHER)
    assert sorted(rows(bronze), key=str) == sorted(rows(raw), key=str)


def test_weather_windows_replace_or_add(spark, centroids, responses, tmp_path):
    lake = Lake(str(tmp_path))

    def run(times, replace, value=20.0):
        plans.ingest_weather(
            spark, responses(weather_body(times, value)), centroids, lake,
            replace=replace, ingested_at=stamp(8),
        )
        raw = read_table(spark, lake.raw("weather_daily"), RAW_WEATHER)
        return sorted({(str(r.date), r.precipitation_sum) for r in raw.collect()})

    assert run(APRIL[:2], "table") == [("2025-04-01", 20.0), ("2025-04-02", 20.0)]
    assert run(APRIL[1:], "partitions", 21.0) == [
        ("2025-04-01", 20.0), ("2025-04-02", 21.0), ("2025-04-03", 21.0)]
    assert run(APRIL[2:], "table") == [("2025-04-03", 20.0)]


def test_weather_variables_left_out_are_null(spark, centroids, responses, tmp_path):
    lake = Lake(str(tmp_path))
    plans.ingest_weather(
        spark, responses(weather_body(APRIL, 20.0)), centroids, lake,
        variables=["temperature_2m_max"],
    )
    row = read_table(spark, lake.raw("weather_daily"), RAW_WEATHER).head()
    assert (row.temperature_2m_max, row.precipitation_sum) == (20.0, None)


def test_batch_without_response_fails(spark, centroids, responses, tmp_path):
    with pytest.raises(ValueError, match="no response for batch 1"):
        plans.ingest_weather(
            spark, responses(weather_body(APRIL, 20.0)), centroids,
            Lake(str(tmp_path)), batch_size=1,
        )


def test_yield_ingestion_gate_and_skip(spark, responses, tmp_path):
    lake = Lake(str(tmp_path))
    landed = responses(
        yield_body({}, {"county_code": "057"}, {"year": "2024"}),
        yield_body({"commodity_desc": "SOYBEANS", "state_alpha": "IL"}),
        key=False,
    )
    with pytest.raises(op.RecordLimitExceeded, match="2 records for CORN/NE/2025"):
        plans.ingest_yield(spark, landed, lake, limit=2)
    assert not op.year_is_loaded(spark, lake.raw("nass_yield"), 2025)

    first = plans.ingest_yield_if_new(spark, landed, lake, limit=3, ingested_at=stamp(8))
    assert (first.status, first.rows) == ("loaded", 3)
    again = plans.ingest_yield_if_new(spark, landed, lake, limit=3)
    assert (again.status, again.rows) == ("skipped", 0)
    raw = read_table(spark, lake.raw("nass_yield"), RAW_YIELD)
    assert {(r.commodity_desc, r.year) for r in raw.collect()} == {("CORN", 2025), ("SOYBEANS", 2025)}

    plans.ingest_yield(spark, landed, lake, year=2024, replace="partitions")
    assert raw.sparkSession.read.parquet(lake.raw("nass_yield")).count() == 4


def test_backfill_builds_and_checks_every_model(spark, centroids, responses, tmp_path):
    lake = Lake(str(tmp_path))

    def run(times, value, **options):
        return plans.backfill(
            spark, lake,
            weather_payloads=responses(weather_body(times, value)),
            yield_payloads=responses(
                yield_body({}, {"county_code": "057", "Value": "(D)"},
                           {"county_code": "000", "agg_level_desc": "STATE"}),
                key=False,
            ),
            points=centroids,
            weather_start=day("2025-04-01"),
            **options,
        )

    reports, models, results = run(APRIL, 20.0)
    assert {name: r.rows for name, r in reports.items()} == {"weather_daily": 6, "nass_yield": 3}
    assert {name: model.count() for name, model in models.items()} == {
        "stg_weather_daily": 6, "stg_nass_yield": 2, "int_weather_growing_season": 2,
        "dim_county": 2, "dim_commodity": 2, "dim_date": 365, "fact_weather_daily": 6,
        "fact_crop_yield": 2, "weather_yield_analysis": 2,
    }
    assert results.count() == 72
    assert rows(results.filter("failures > 0")) == []
    plans.enforce_checks(results)

    plans.register_views(models)
    top = spark.sql(
        "SELECT county_name, yield_value, gdd FROM weather_yield_analysis ORDER BY fips"
    )
    assert rows(top) == [("Douglas County", 58.3, 30.0), ("Dixon County", None, 30.0)]

    opened = plans.open_models(spark, lake)
    assert {n: m.columns for n, m in opened.items()} == {n: m.columns for n, m in models.items()}
    assert {n: m.count() for n, m in opened.items()} == {n: m.count() for n, m in models.items()}

    # A later window: raw holds it alone, the fact keeps the earlier days.
    _, models, _ = run(["2025-04-03", "2025-04-04"], 30.0, build_options={"store_staging": False})
    fact = read_table(spark, lake.mart("fact_weather_daily"), STAGED_WEATHER)
    assert sorted({(r.date.day, r.precipitation_sum) for r in fact.collect()}) == [
        (1, 20.0), (2, 20.0), (3, 30.0), (4, 30.0)]
    assert models["stg_weather_daily"].count() == 4
    opened = plans.open_models(spark, lake)
    assert opened["stg_weather_daily"].count() == 4
    assert opened["int_weather_growing_season"].count() == 2


@pytest.mark.parametrize("store_staging", [True, False])
def test_models_reopen_with_the_options_of_the_build(
    spark, centroids, raw_weather, raw_yields, tmp_path, store_staging
):
    lake = Lake(str(tmp_path))
    days = [
        {"fips": "31057", "date": day(d), "temperature_2m_max": t, "_ingested_at": stamp(9)}
        for d, t in (("2025-01-15", 16.0), ("2025-02-20", 20.0), ("2025-05-02", 30.0))
    ]
    raw_weather(*days).write.partitionBy("date").parquet(lake.raw("weather_daily"))
    raw_yields({}).write.partitionBy("year").parquet(lake.raw("nass_yield"))
    plans.build_warehouse(spark, lake, centroids, store_staging=True)
    built = plans.build_warehouse(
        spark, lake, centroids, season_start="01-01", season_end="03-31", store_staging=store_staging
    )
    opened = plans.open_models(spark, lake)
    assert opened["int_weather_growing_season"].head().tmax_mean == 18.0
    for name, model in built.items():
        assert sorted(map(str, rows(opened[name]))) == sorted(map(str, rows(model))), name


def test_failing_checks_are_reported(spark, centroids, raw_weather, raw_yields, tmp_path):
    models = plans.build_models(
        spark,
        raw_weather({"fips": "31055", "date": day("2025-05-01"), "_ingested_at": stamp(8)}),
        raw_yields({}, {}, {"county_code": "777"}, {"commodity_desc": "WHEAT"}),
        centroids,
        Lake(str(tmp_path)),
    )
    results = plans.run_checks(models).cache()
    with pytest.raises(plans.ChecksFailed, match=r"accepted_values\(commodity\) 1"):
        plans.enforce_checks(results)
    failing = results.filter("failures > 0").collect()
    got = {(r.model, r.check_name, r.target): r.failures for r in failing}
    assert got["stg_weather_daily", "not_null", "temperature_2m_max"] == 1
    assert got["int_weather_growing_season", "not_null", "gdd"] == 1
    assert got["stg_nass_yield", "unique_combination", "fips,commodity,year"] == 1
    assert got["fact_crop_yield", "accepted_values", "commodity"] == 1
    assert got["fact_crop_yield", "relationships", "fips"] == 1
    assert got["weather_yield_analysis", "relationships", "commodity"] == 1
