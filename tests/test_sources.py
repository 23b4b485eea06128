import json

import pytest

from agroweather.operators import point_batches
from agroweather.plans import build_county_seed
from agroweather.sources import (
    attach_points,
    in_scope,
    landed_keys,
    parse_weather_payloads,
    parse_yield_payloads,
    read_centroids,
    read_gazetteer,
    read_payloads,
)
from tests.conftest import day, rows

TMAX = "temperature_2m_max"
DAYS = ["2024-06-14", "2024-06-15"]
POINTS = [("31055", 41.25, -96.0), ("20173", 37.5, -97.5), ("29095", 39.0, -94.5)]


def block(lat, lon, values, time=None, **more):
    return {"latitude": lat, "longitude": lon,
            "daily": {"time": DAYS if time is None else time, TMAX: values, **more}}


def payloads(spark, *pairs):
    return spark.createDataFrame(
        [(fips, body if isinstance(body, str) else json.dumps(body)) for fips, body in pairs],
        "fips_list array<string>, body string",
    )


def parse(spark, fips, body, variables=(TMAX,)):
    return parse_weather_payloads(payloads(spark, (fips, body)), list(variables))


def test_array_and_bare_object_responses(spark):
    """Three points in one response, each with days of its own, and one point without a list."""
    summer, autumn = ["2024-07-30", "2024-07-31", "2024-08-01"], ["2024-09-09"]
    landed = payloads(
        spark,
        (
            ["20173", "29095", "31055"],
            [
                block(37.625, -97.25, [33.5, None, 36.25], time=summer),
                block(39.0, -94.5, [], time=[]),
                block(41.25, -96.0, [-2.75], time=autumn),
            ],
        ),
        (["46099"], block(43.5, -96.75, [29.0, 28.5, 0.0], time=summer)),
    )
    got = sorted(rows(parse_weather_payloads(landed, [TMAX])), key=str)
    assert got == [
        ("20173", 37.625, -97.25, day("2024-07-30"), 33.5),
        ("20173", 37.625, -97.25, day("2024-07-31"), None),
        ("20173", 37.625, -97.25, day("2024-08-01"), 36.25),
        ("31055", 41.25, -96.0, day("2024-09-09"), -2.75),
        ("46099", 43.5, -96.75, day("2024-07-30"), 29.0),
        ("46099", 43.5, -96.75, day("2024-07-31"), 28.5),
        ("46099", 43.5, -96.75, day("2024-08-01"), 0.0),
    ]


def test_values_beyond_the_last_day_are_ignored(spark):
    assert parse(spark, ["19001"], block(1.0, 2.0, [1.0, 2.0, 3.0])).count() == 2


def test_block_without_days_gives_no_rows(spark):
    assert parse(spark, ["19001"], block(1.0, 2.0, [], time=[])).count() == 0


@pytest.mark.parametrize(
    "fips, body, message",
    [
        (["19001", "17001"], [block(1.0, 2.0, [1.0, 2.0])], "one block per requested point"),
        (["19001"], [block(1.0, 2.0, [1.0, 2.0])] * 2, "one block per requested point"),
        (None, block(1.0, 2.0, [1.0, 2.0]), "one block per requested point"),
        (["19001"], block(1.0, 2.0, [1.0]), "block lacks"),
        (["19001"], block(1.0, 2.0, None), "block lacks"),
        (["19001"], {"latitude": 1.0, "longitude": 2.0, "daily": {"time": DAYS}}, "block lacks"),
        (["19001"], {"latitude": 1.0, "longitude": 2.0}, "block lacks"),
        (["19001"], {"longitude": 2.0, "daily": {"time": DAYS, TMAX: [1, 2]}}, "block lacks"),
        (["19001"], block(1.0, 2.0, [1.0, 2.0], time=["2024-06-14", "2024-6-15"]), "ISO date"),
        (["19001"], block(1.0, 2.0, [1.0, 2.0], time=["2024-06-14", "2024-06-31"]), "ISO date"),
        (["19001"], '{"latitude": 1.0, ', "MALFORMED|alformed"),
    ],
)
def test_broken_responses_fail(spark, fips, body, message):
    with pytest.raises(Exception, match=message):
        parse(spark, fips, body).collect()


def test_checks_also_run_when_only_the_key_is_read(spark):
    with pytest.raises(Exception, match="block lacks"):
        parse(spark, ["19001"], block(1.0, 2.0, [1.0])).select("fips").collect()
    with pytest.raises(Exception, match="block lacks"):
        parse(spark, ["19001"], block(1.0, 2.0, [1.0])).count()


def test_point_batches_follow_the_key_order(spark):
    points = spark.createDataFrame(POINTS, "fips string, lat double, lon double")
    got = rows(point_batches(points, 2).orderBy("batch_id"))
    assert got == [
        (0, ["20173", "29095"], "37.5,39.0", "-97.5,-94.5"),
        (1, ["31055"], "41.25", "-96.0"),
    ]


def test_points_without_a_code_keep_their_place(spark):
    points = spark.createDataFrame(
        [*POINTS, (None, 1.0, 2.0), (None, 3.0, 4.0)], "fips string, lat double, lon double"
    )
    got = [r.fips_list for r in point_batches(points, 2).orderBy("batch_id").collect()]
    assert got == [[None, None], ["20173", "29095"], ["31055"]]


def test_point_batches_against_a_plain_sort(spark):
    made = [(f"{s:02d}{c:03d}", float(c), float(s)) for s in (3, 19, 20) for c in range(0, 200, 3)]
    made += made[10:14]  # repeated keys keep all their rows
    points = spark.createDataFrame(made[::-1], "fips string, lat double, lon double")
    got = [r.fips_list for r in point_batches(points, 7).orderBy("batch_id").collect()]
    want = sorted(p[0] for p in made)
    assert got == [want[i : i + 7] for i in range(0, len(want), 7)]


def test_landed_files_meet_their_batches(spark, tmp_path):
    points = spark.createDataFrame(POINTS, "fips string, lat double, lon double")
    batches = point_batches(points, 2)
    landed = tmp_path / "landed"
    for batch, body in [(0, [block(37.5, -97.5, [31, 30]), block(39.0, -94.5, [27, 26])]),
                        (1, block(41.25, -96.0, [22, 19]))]:
        (landed / f"batch_id={batch}").mkdir(parents=True)
        (landed / f"batch_id={batch}" / "r.json").write_text(json.dumps(body, indent=1))
    read = read_payloads(spark, str(landed), "batch_id")
    got = parse_weather_payloads(attach_points(read, batches), [TMAX]).collect()
    assert {(r.fips, r.date.day, r[4]) for r in got} == {
        ("20173", 14, 31.0), ("20173", 15, 30.0), ("29095", 14, 27.0),
        ("29095", 15, 26.0), ("31055", 14, 22.0), ("31055", 15, 19.0),
    }
    assert sorted(rows(landed_keys(spark, str(landed), "batch_id"))) == [(0,), (1,)]


RECORD = {
    "unit_desc": "BU / ACRE", "statisticcat_desc": "YIELD", "commodity_desc": "SOYBEANS",
    "state_fips_code": "31", "state_alpha": "NE", "county_code": "055", "county_name": "DOUGLAS",
    "year": "2025", "Value": "58.3", "short_desc": "per acre of the crop", "CV (%)": "4.1",
}


def yields(spark, *bodies):
    return parse_yield_payloads(
        spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")
    )


def test_yield_record_projection(spark):
    assert [r.asDict() for r in yields(spark, {"data": [RECORD]}).collect()] == [
        {
            "commodity_desc": "SOYBEANS", "statisticcat_desc": "YIELD", "unit_desc": "BU / ACRE",
            "state_alpha": "NE", "state_fips_code": "31", "county_code": "055",
            "county_name": "DOUGLAS", "agg_level_desc": "", "short_desc": "per acre of the crop",
            "year": 2025, "value_raw": "58.3",
        }
    ]


def test_missing_and_null_fields(spark):
    no_keys = {k: v for k, v in RECORD.items() if k not in ("county_name", "Value", "year")}
    got = yields(
        spark,
        {"data": [no_keys, {**RECORD, "county_name": None, "year": ""}, {**RECORD, "year": 2025}]},
        {"error": ["no data"]},
        {"data": []},
    ).collect()
    assert [(r.county_name, r.value_raw, r.year) for r in got] == [
        ("", "", None), (None, "58.3", None), ("DOUGLAS", "58.3", 2025),
    ]


@pytest.mark.parametrize("year", ["next", "2025.0"])
def test_bad_year_fails(spark, year):
    with pytest.raises(Exception, match="year is not a whole number"):
        yields(spark, {"data": [{**RECORD, "year": year}]}).collect()


def test_scope(spark):
    made = [
        RECORD,
        {**RECORD, "agg_level_desc": "STATE"},
        {**RECORD, "agg_level_desc": "AGRICULTURAL DISTRICT"},
        {**RECORD, "commodity_desc": "WHEAT"},
        {**RECORD, "state_alpha": "TX"},
        {**RECORD, "year": "2024"},
        {**RECORD, "statisticcat_desc": "PRODUCTION"},
    ]
    kept = in_scope(
        yields(spark, {"data": made}), commodities=["CORN", "SOYBEANS"], states=["NE"], year=2025
    )
    assert sorted(r.agg_level_desc for r in kept.collect()) == ["", "STATE"]


def test_county_seed(spark, tmp_path):
    source = tmp_path / "gaz.txt"
    source.write_text(
        "USPS|GEOID|NAME|ALAND|INTPTLAT|INTPTLONG               \n"
        "TX|48001|Anderson County|1|31.8|-95.6  \n"
        "IL|17003|Alexander County|1| 37.183658|-89.349516    \n"
        "AL|01001|Autauga County|1|32.5|-86.6  \n"
        "IL|17001|Adams County|1|39.986052 |-91.194961    \n"
    )
    assert read_gazetteer(spark, str(source)).columns[-1] == "INTPTLONG"
    seed = str(tmp_path / "seed")
    assert build_county_seed(spark, str(source), seed, ["IL", "AL"]) == 3
    assert rows(read_centroids(spark, seed)) == [
        ("01001", "AL", "Autauga County", 32.5, -86.6),
        ("17001", "IL", "Adams County", 39.986052, -91.194961),
        ("17003", "IL", "Alexander County", 37.183658, -89.349516),
    ]
    text = next((tmp_path / "seed").glob("part-*")).read_text().splitlines()
    assert text[0] == "fips,state_alpha,county_name,lat,lon"
    assert text[2] == "17001,IL,Adams County,39.986052,-91.194961"


def test_centroids_with_crlf_and_bad_numbers(spark, tmp_path):
    good = tmp_path / "c.csv"
    good.write_bytes(b"fips,state_alpha,county_name,lat,lon\r\n01001,AL,A County,32.5,-86.6\r\n")
    assert rows(read_centroids(spark, str(good))) == [("01001", "AL", "A County", 32.5, -86.6)]
    bad = tmp_path / "b.csv"
    bad.write_text("fips,state_alpha,county_name,lat,lon\n01001,AL,A County,north,-86.6\n")
    with pytest.raises(Exception):
        read_centroids(spark, str(bad)).collect()
