import math

import pytest
from pyspark.sql import functions as F

from agroweather.functions import (
    bu_acre_to_t_ha,
    county_fips,
    in_season,
    is_county_code,
    iso_date,
    parse_yield,
)
from tests.conftest import day

YIELD_TEXTS = [
    ("201.0", 201.0),
    (" 201.0 ", 201.0),
    ("1,234.5", 1234.5),
    ("(D)", None),
    (" (D)", None),
    ("(Z)", None),
    ("(NA)", None),
    ("", None),
    (None, None),
    ("1.5d", None),
    ("1.5f", None),
    ("0x1p3", None),
    ("1_000", None),
    ("12 34", None),
    ("inf", math.inf),
    ("-Infinity", -math.inf),
    ("NaN", math.nan),
    (".5", 0.5),
    ("5.", 5.0),
    ("+3", 3.0),
    ("-7", -7.0),
    ("1e3", 1000.0),
]


def test_parse_yield(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in YIELD_TEXTS)), "i int, text string")
    got = {r.i: r.v for r in df.select("i", parse_yield(F.col("text")).alias("v")).collect()}
    for i, (text, want) in enumerate(YIELD_TEXTS):
        if want is not None and math.isnan(want):
            assert math.isnan(got[i]), text
        else:
            assert got[i] == want, text


def test_unit_conversion(spark):
    df = spark.createDataFrame(
        [("corn", 200.0), ("CORN", 200.0), ("soybeans", 59.0), ("wheat", 50.0), ("corn", None)],
        "commodity string, y double",
    )
    got = [r[0] for r in df.select(bu_acre_to_t_ha(F.col("y"), F.col("commodity"))).collect()]
    assert got[:3] == pytest.approx([12.55354, 12.55354, 3.9678149])
    assert got[3:] == [None, None]


def test_county_keys(spark):
    df = spark.createDataFrame(
        [("19", "1"), ("1", "001"), (None, "001"), ("19", "000"), ("19", "998"), ("19", ""), ("19", None)],
        "s string, c string",
    )
    fips = [r[0] for r in df.select(county_fips(F.col("s"), F.col("c"))).collect()]
    assert fips[:3] == ["19001", "01001", None]
    kept = [tuple(r) for r in df.filter(is_county_code(F.col("c"))).collect()]
    assert kept == [("19", "1"), ("1", "001"), (None, "001")]


def test_season_bounds_are_inclusive_and_do_not_wrap(spark):
    days = ["2025-03-31", "2025-04-01", "2025-10-31", "2025-11-01"]
    df = spark.createDataFrame([(day(d),) for d in days], "d date")
    assert [r[0] for r in df.select(in_season(F.col("d"))).collect()] == [False, True, True, False]
    wrapped = df.select(in_season(F.col("d"), "11-01", "03-31")).collect()
    assert not any(r[0] for r in wrapped)


def test_season_bounds_have_to_be_month_and_day(spark):
    with pytest.raises(ValueError):
        in_season(F.lit(day("2025-04-01")), "4-1", "10-31")


@pytest.mark.parametrize("text", ["2025-4-1", "2025-02-30", "20250401", "", None])
def test_iso_date_is_strict(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="not an ISO date"):
        df.select(iso_date(F.col("t"))).collect()
