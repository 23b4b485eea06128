"""Models on random rows against plain Python over the same rows."""

import random
from collections import defaultdict
from datetime import timedelta

import pytest

from agroweather import operators as op
from agroweather import plans
from agroweather.schemas import RAW_WEATHER, STAGED_WEATHER, WEATHER_VARIABLES
from tests.conftest import day, rows, stamp


def random_weather(seed, n_rows):
    """Few keys, few distinct values: many copies, many ties, NULLs everywhere they may be."""
    pick = random.Random(seed)

    def measure(name):
        values = [None, -5.0, 0.0, 0.5, 12.5, 30.0, 31.0]
        return pick.choice(values)

    # A third of all rows share one key.
    made = []
    for i in range(n_rows):
        hot = i % 3 == 0
        made.append(
            {
                "fips": "31055" if hot else f"19{pick.randrange(1, 6):03d}",
                "date": day("2025-04-01")
                if hot
                else day("2024-03-25") + timedelta(days=pick.randrange(0, 600, 7)),
                "_ingested_at": pick.choice([None, stamp(8), stamp(9)]),
                **{name: measure(name) for name in WEATHER_VARIABLES},
            }
        )
    return made


def latest(made):
    def rank(row):
        order = (row["_ingested_at"], *[row[name] for name in WEATHER_VARIABLES])
        return tuple((value is not None, value) if value is not None else (False, 0) for value in order)

    def comparable(row):
        return tuple(
            (present, value.timestamp() if hasattr(value, "timestamp") else value)
            for present, value in rank(row)
        )

    best = {}
    for row in made:
        key = row["fips"], row["date"]
        if key not in best or comparable(row) > comparable(best[key]):
            best[key] = row
    return best


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


@pytest.mark.parametrize("seed", [1, 2])
def test_staging_and_features(spark, raw_weather, seed):
    made = random_weather(seed, 900)
    best = latest(made)
    staged = plans.stage_weather(raw_weather(*made).repartition(5))
    want = {
        (fips, date, *[row[name] for name in WEATHER_VARIABLES])
        for (fips, date), row in best.items()
    }
    assert {tuple(r)[:-1] for r in staged.collect()} == want
    assert staged.columns == STAGED_WEATHER.names

    seasons = defaultdict(list)
    for (fips, date), row in best.items():
        if (4, 1) <= (date.month, date.day) <= (10, 31):
            seasons[fips, date.year].append(row)
    expected = {}
    for key, days in seasons.items():
        tmax = [d["temperature_2m_max"] for d in days]
        tmin = [d["temperature_2m_min"] for d in days]
        rain = [d["precipitation_sum"] for d in days]
        expected[key] = (
            total(
                None if a is None or b is None else max(0.0, (a + b) / 2 - 10)
                for a, b in zip(tmax, tmin)
            ),
            total(rain),
            sum(a is not None and a > 30 for a in tmax),
            sum(a is not None and a < 1 for a in rain),
            total(d["et0_fao_evapotranspiration"] for d in days),
            mean(d["shortwave_radiation_sum"] for d in days),
            mean(tmax),
            mean(tmin),
        )
    got = {(r.fips, r.year): tuple(r)[2:] for r in plans.season_features(staged).collect()}
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values), key


def test_duplicates_and_reconciliation_with_a_hot_key(spark, raw_weather):
    made = random_weather(3, 600)
    raw = raw_weather(*made).repartition(5)
    copies = defaultdict(int)
    for row in made:
        copies[row["fips"], row["date"]] += 1
    got = {(r.fips, r.date): r.n_records for r in op.duplicate_keys(raw, ["fips", "date"]).collect()}
    assert got == {key: n for key, n in copies.items() if n > 1}
    assert max(got.values()) >= 200
    counts = op.reconcile({"raw": raw, "staging": plans.stage_weather(raw)}, ["fips", "date"])
    assert rows(counts) == [("raw", 600, len(copies)), ("staging", len(copies), len(copies))]
    assert raw.columns == RAW_WEATHER.names
