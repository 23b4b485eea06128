import math

import pytest

from agroweather import plans
from tests.conftest import day, rows, stamp


def test_latest_load_wins_and_null_stamps_lose(raw_weather):
    key = {"fips": "31055", "date": day("2025-04-01")}
    raw = raw_weather(
        {**key, "temperature_2m_max": 1.0, "_ingested_at": stamp(8)},
        {**key, "temperature_2m_max": 2.0, "_ingested_at": stamp(9)},
        {**key, "temperature_2m_max": 3.0, "_ingested_at": None},
    )
    assert [r.temperature_2m_max for r in plans.stage_weather(raw).collect()] == [2.0]


def test_equal_stamps_are_broken_by_the_measures(raw_weather):
    key = {"fips": "31055", "date": day("2025-04-01"), "_ingested_at": stamp(8)}
    made = [
        {**key, "temperature_2m_max": 5.0, "precipitation_sum": 1.0},
        {**key, "temperature_2m_max": 5.0, "precipitation_sum": 2.0},
        {**key, "temperature_2m_max": None, "precipitation_sum": 9.0},
    ]
    for order in (made, made[::-1]):
        got = plans.stage_weather(raw_weather(*order)).collect()
        assert [r.precipitation_sum for r in got] == [2.0]


def test_staged_weather_renames(raw_weather):
    raw = raw_weather(
        {
            "fips": "31055",
            "date": day("2025-04-01"),
            "shortwave_radiation_sum": 3.0,
            "windspeed_10m_max": 4.0,
            "_ingested_at": stamp(8),
        }
    )
    row = plans.stage_weather(raw).head()
    assert (row.solar_radiation_mjm2, row.wind_speed_kmh) == (3.0, 4.0)
    assert "latitude" not in row.asDict()


def test_staged_yields(raw_yields):
    raw = raw_yields(
        {},
        {"county_code": "3", "value_raw": "1,000.5", "commodity_desc": "SOYBEANS"},
        {"value_raw": "(D)"},
        {"commodity_desc": "WHEAT", "value_raw": "50"},
        {"county_code": "000"},
        {"county_code": "998"},
        {"county_code": ""},
        {"county_code": None},
        {"unit_desc": "TONS / ACRE"},
        {"statisticcat_desc": "PRODUCTION"},
    )
    got = plans.stage_yields(raw)
    assert got.columns == [
        "fips", "commodity", "state_alpha", "year", "unit",
        "yield_value", "yield_value_t_ha", "_ingested_at",
    ]
    values = [(r.fips, r.commodity, r.yield_value, r.yield_value_t_ha) for r in got.collect()]
    assert values[0] == ("31055", "corn", 160.0, 160.0 * 0.0627677)
    assert values[1] == ("31003", "soybeans", 1000.5, 1000.5 * 0.0672511)
    assert values[2] == ("31055", "corn", None, None)
    assert values[3] == ("31055", "wheat", 50.0, None)
    assert len(values) == 4


SEASON_DAYS = [
    ("31055", "2025-03-31", 40.0, 20.0, 0.0, 9.0, 9.0),
    ("31055", "2025-04-01", 30.0, 10.0, 1.0, 2.0, 10.0),
    ("31055", "2025-07-01", 30.5, 20.5, 0.9, 5.0, 20.0),
    ("31055", "2025-08-01", 12.0, 2.0, 5.0, 1.0, 15.0),
    ("31055", "2025-10-31", None, 5.0, None, 1.0, None),
    ("31055", "2025-11-01", 40.0, 20.0, 0.0, 9.0, 9.0),
    ("31057", "2025-05-01", None, 5.0, 0.0, None, None),
    ("31059", "2025-06-01", math.nan, 5.0, math.nan, 1.0, 1.0),
]


def _season(staged_weather):
    return staged_weather(
        *[
            {
                "fips": fips,
                "date": day(date),
                "temperature_2m_max": tmax,
                "temperature_2m_min": tmin,
                "precipitation_sum": precipitation,
                "et0_fao_evapotranspiration": et0,
                "solar_radiation_mjm2": radiation,
            }
            for fips, date, tmax, tmin, precipitation, et0, radiation in SEASON_DAYS
        ]
    )


def test_season_features(staged_weather):
    got = {r.fips: r for r in plans.season_features(_season(staged_weather)).collect()}
    a, b, c = got["31055"], got["31057"], got["31059"]
    assert a.year == 2025
    assert (a.gdd, a.heat_stress_days, a.dry_days, a.et0_total_mm) == (25.5, 1, 1, 9.0)
    assert (a.precip_total_mm, a.radiation_mean) == pytest.approx((6.9, 15.0))
    assert (a.tmax_mean, a.tmin_mean) == pytest.approx((72.5 / 3, 9.375))
    assert tuple(b)[2:] == (None, 0.0, 0, 1, None, None, None, 5.0)
    assert math.isnan(c.gdd) and math.isnan(c.precip_total_mm) and math.isnan(c.tmax_mean)
    assert (c.heat_stress_days, c.dry_days, c.et0_total_mm) == (0, 0, 1.0)


def test_wrapping_season_holds_nothing(staged_weather):
    assert plans.season_features(_season(staged_weather), "11-01", "03-31").isEmpty()


def test_date_dimension(spark):
    dates = plans.date_dimension(spark).collect()
    assert len(dates) == 365
    assert sum(r.is_growing_season for r in dates) == 214
    last = max(dates, key=lambda r: r.date)
    assert tuple(last) == (day("2025-12-31"), 2025, 12, 31, 365, False)


def test_commodity_dimension(spark):
    assert rows(plans.commodity_dimension(spark)) == [
        ("corn", "Corn", 10, 56),
        ("soybeans", "Soybeans", 10, 60),
    ]


def test_analysis_needs_yield_weather_and_centroid(spark, staged_weather, raw_yields):
    def season_day(fips):
        return {"fips": fips, "date": day("2025-06-01"), "temperature_2m_max": 20.0,
                "temperature_2m_min": 10.0, "precipitation_sum": 3.0,
                "et0_fao_evapotranspiration": 4.0}

    features = plans.season_features(
        staged_weather(season_day("31055"), season_day("31057"), season_day("31061"))
    )
    counties = spark.createDataFrame(
        [("31055", "NE", "Douglas County", 1.0, 2.0), ("31059", "IA", "B", 1.0, 2.0),
         ("31061", "IA", "C", 1.0, 2.0)],
        "fips string, state_alpha string, county_name string, lat double, lon double",
    )
    yields = plans.crop_yield_fact(
        plans.stage_yields(
            raw_yields(
                {"county_code": "055"},
                {"county_code": "055", "commodity_desc": "SOYBEANS", "value_raw": "(D)"},
                {"county_code": "057"},
                {"county_code": "005"},
                {"county_code": "055", "year": 2024},
            )
        )
    )
    got = plans.weather_yield_analysis(yields, features, counties).orderBy("commodity").collect()
    assert [tuple(r) for r in got] == [
        ("31055", "NE", "Douglas County", "corn", 2025, 160.0, 160.0 * 0.0627677, "BU / ACRE",
         5.0, 3.0, 0, 0, 4.0, 20.0),
        ("31055", "NE", "Douglas County", "soybeans", 2025, None, None, "BU / ACRE",
         5.0, 3.0, 0, 0, 4.0, 20.0),
    ]


def test_state_yields_skip_suppressed_counties(raw_yields):
    yields = plans.crop_yield_fact(
        plans.stage_yields(
            raw_yields(
                {"county_code": "055", "value_raw": "100"},
                {"county_code": "057", "value_raw": "300"},
                {"county_code": "005", "value_raw": "(D)"},
            )
        )
    )
    assert rows(plans.state_yields(yields)) == [("NE", "corn", 2025, 200.0, 100.0, 300.0, 2)]


def test_correlation(spark):
    mart = spark.createDataFrame(
        [("corn", 1.0, 2.0, -1.0), ("corn", 2.0, 4.0, -2.0), ("corn", 3.0, 6.0, -3.0),
         ("corn", None, 9.0, 9.0)],
        "commodity string, yield_value double, gdd double, tmax_mean double",
    )
    got = {r.feature: r.correlation for r in
           plans.weather_yield_correlation(mart, ["gdd", "tmax_mean"]).collect()}
    assert got == pytest.approx({"gdd": 1.0, "tmax_mean": -1.0})
