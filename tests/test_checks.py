from dataclasses import replace
from datetime import timedelta

import pytest

from agroweather import operators as op
from agroweather.plans import (
    CHECKS,
    RULES,
    AgeLimits,
    ChecksFailed,
    StaleSource,
    enforce_checks,
    enforce_freshness,
    quarantine,
    run_checks,
    source_freshness,
    with_rules,
)
from agroweather.plans.catalog import ModelChecks, _pass_per_check
from agroweather.schemas import RAW_YIELD
from agroweather.sources import Lake
from tests.conftest import rows, stamp


# The declared checks of every model, written down apart from the catalog.
DECLARED = """
stg_weather_daily not_null fips date temperature_2m_max temperature_2m_min precipitation_sum
stg_weather_daily not_null et0_fao_evapotranspiration solar_radiation_mjm2 _ingested_at
stg_weather_daily unique_combination fips,date
stg_nass_yield not_null fips commodity state_alpha year _ingested_at
stg_nass_yield unique_combination fips,commodity,year
stg_nass_yield accepted_values commodity
int_weather_growing_season not_null fips year gdd precip_total_mm
int_weather_growing_season unique_combination fips,year
dim_county not_null fips state_alpha county_name lat lon
dim_county unique fips
dim_commodity not_null commodity display_name gdd_base_c bushel_weight_lb
dim_commodity unique commodity
dim_commodity accepted_values commodity
dim_date not_null date year month day day_of_year is_growing_season
dim_date unique date
fact_weather_daily not_null fips date temperature_2m_max temperature_2m_min precipitation_sum _ingested_at
fact_weather_daily unique_combination fips,date
fact_weather_daily relationships fips
fact_crop_yield not_null fips commodity state_alpha year unit _ingested_at
fact_crop_yield unique_combination fips,commodity,year
fact_crop_yield accepted_values commodity
fact_crop_yield relationships fips
weather_yield_analysis not_null fips state_alpha county_name commodity year unit
weather_yield_analysis not_null gdd precip_total_mm heat_stress_days dry_days et0_total_mm tmax_mean
weather_yield_analysis unique_combination fips,commodity,year
weather_yield_analysis relationships fips commodity
"""


def test_declared_checks():
    want = {
        (model, check, target)
        for model, check, *targets in map(str.split, DECLARED.strip().splitlines())
        for target in targets
    }
    got = {
        (model, check, target)
        for model, declared in CHECKS.items()
        for check, targets in (
            ("not_null", declared.not_null),
            ("unique", declared.unique),
            ("unique_combination", [",".join(declared.unique_together)] if declared.unique_together else []),
            ("accepted_values", declared.accepted),
            ("relationships", declared.references),
        )
        for target in targets
    }
    assert got == want and len(want) == 72
    assert sum(len(checks) for checks in CHECKS.values()) == 72
    parents = {(m, c): p for m, d in CHECKS.items() for c, p in d.references.items()}
    assert parents == {
        ("fact_weather_daily", "fips"): ("dim_county", "fips"),
        ("fact_crop_yield", "fips"): ("dim_county", "fips"),
        ("weather_yield_analysis", "fips"): ("dim_county", "fips"),
        ("weather_yield_analysis", "commodity"): ("dim_commodity", "commodity"),
    }


@pytest.fixture
def suite(spark, tmp_path):
    """A child with every kind of failure, its parent with repeated and NULL keys, and their checks."""
    child = [("a", 1, 1.0), ("a", 1, None), ("b", 2, 1.0), ("c", None, 1.0), ("c", None, 1.0),
             (None, 3, 1.0), (None, 3, None), ("d", 4, 1.0)]
    parent = [("a",), ("a",), ("b",), (None,)]
    spark.createDataFrame(child, "k string, y int, v double").write.parquet(str(tmp_path / "child"))
    spark.createDataFrame(parent, "id string").write.parquet(str(tmp_path / "parent"))
    models = {name: spark.read.parquet(str(tmp_path / name)) for name in ("child", "parent")}
    checks = {
        "child": ModelChecks(
            not_null=["k", "y", "v"],
            unique_together=["k", "y"],
            accepted={"k": ["a", "b"]},
            references={"k": ("parent", "id")},
        ),
        "parent": ModelChecks(not_null=["id"], unique=["id"]),
    }
    want = {
        ("child", "not_null", "k"): 2, ("child", "not_null", "y"): 2, ("child", "not_null", "v"): 2,
        ("child", "unique_combination", "k,y"): 3, ("child", "accepted_values", "k"): 2,
        ("child", "relationships", "k"): 3, ("parent", "not_null", "id"): 1, ("parent", "unique", "id"): 1,
    }
    return models, checks, want


def test_one_pass_equals_a_pass_per_check(suite):
    models, checks, want = suite
    results = run_checks(models, checks)
    assert {(m, c, t): n for m, c, t, n in rows(results)} == want and results.count() == len(want)
    apart = [r for name, declared in checks.items()
             for df in _pass_per_check(name, declared, models.__getitem__) for r in rows(df)]
    assert sorted(apart) == sorted(rows(results))
    empty = {name: df.limit(0) for name, df in models.items()}
    assert {r.failures for r in run_checks(empty, checks).collect()} == {0}


def test_each_model_is_scanned_once(suite):
    models, checks, _ = suite
    text = run_checks({**models, "parent": models["parent"].where("id IS NOT NULL")}, checks)
    plan = text._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<k:string,y:int,v:double>") == 1
    assert plan.count("k:string") == 1


def test_checks_that_no_key_covers_run_apart(suite):
    models, checks, _ = suite
    loose = {"child": ModelChecks(not_null=["v"], unique=["y"], references={"k": ("parent", "id")})}
    got = {(c, t): n for _, c, t, n in rows(run_checks(models, loose))}
    assert got == {("not_null", "v"): 2, ("unique", "y"): 2, ("relationships", "k"): 3}


def test_null_counts(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(op.null_counts(df, ["k", "v"])) == [("k", 1), ("v", 0)]


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    assert rows(op.duplicate_keys(df, ["k"], ignore_nulls=True)) == [("a", 2)]


def test_unique_combination_counts_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), ("b", 1)], "k string, v int")
    assert sorted(rows(op.duplicate_keys(df, ["k", "v"])), key=str) == [("a", 1, 2), (None, 1, 2)]


def test_accepted_values(spark):
    df = spark.createDataFrame([("corn",), ("wheat",), ("wheat",), (None,)], "c string")
    assert rows(op.unexpected_values(df, "c", ["corn", "soybeans"])) == [("wheat", 2)]


def test_relationships(spark):
    child = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "k string")
    parent = spark.createDataFrame([("x",), (None,)], "id string")
    assert rows(op.orphan_keys(child, "k", parent, "id")) == [("y", 2)]


def test_ranges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (5.0,), (5.1,), (None,)], "v double")
    assert rows(op.out_of_range(df, "v", 0.0, 5.0)) == [(-1.0,), (5.1,)]
    assert rows(op.out_of_range(df, "v", low=0.0)) == [(-1.0,)]


def test_freshness(spark):
    df = spark.createDataFrame([(stamp(8),), (stamp(10),), (None,)], "t timestamp")
    fresh = op.freshness(df, "t", stamp(11), timedelta(hours=1)).head()
    assert (fresh.age_seconds, fresh.stale) == (3600, False)
    assert op.freshness(df, "t", stamp(12), timedelta(hours=1)).head().stale
    assert op.freshness(df.limit(0), "t", stamp(12), timedelta(hours=1)).head().stale


def test_reconcile(spark):
    raw = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    got = op.reconcile({"raw": raw, "staged": raw.distinct(), "none": raw.limit(0)}, ["a", "b"])
    assert rows(got) == [("raw", 3, 2), ("staged", 2, 2), ("none", 0, 0)]


# ---- rules on single rows


def test_rules_join_the_one_pass(suite):
    models, checks, want = suite
    rules = {"child": {"small": "y < 3", "v_and_y": "v + y > 1.5"}, "parent": {}}
    ruled = with_rules(checks, rules)
    results = run_checks(models, ruled)
    # y: 1 1 2 NULL NULL 3 3 4 with v: 1 - 1 1 1 1 - 1; a condition that is NULL passes
    want = {**want, ("child", "holds", "small"): 3, ("child", "holds", "v_and_y"): 0}
    assert {(m, c, t): n for m, c, t, n in rows(results)} == want
    plan = run_checks({"child": models["child"]}, {"child": replace(ruled["child"], references={})})
    assert plan._jdf.queryExecution().executedPlan().toString().count("ReadSchema") == 1
    apart = [r for df in _pass_per_check("child", ruled["child"], models.__getitem__) for r in rows(df)]
    assert ("child", "holds", "small", 3) in apart


def test_a_negative_yield_is_named_and_held(spark, tmp_path):
    made = [("19001", "corn", "IA", 2025, v, None, "BU / ACRE", stamp(8)) for v in (-1.0, 180.0, None, float("nan"))]
    kept = [("19003", "corn", "IA", 2025, 200.0, None, "BU / ACRE", stamp(8))]
    yields = spark.createDataFrame(
        [(f"{f}{i}", *rest) for i, (f, *rest) in enumerate(made + kept)],
        "fips string, commodity string, state_alpha string, year long, yield_value double, "
        "yield_value_t_ha double, unit string, _ingested_at timestamp",
    )
    checks = {"fact_crop_yield": replace(with_rules(CHECKS)["fact_crop_yield"], references={})}
    with pytest.raises(ChecksFailed, match=r"fact_crop_yield: holds\(yield_value\) 2"):
        enforce_checks(run_checks({"fact_crop_yield": yields}, checks))
    lake = Lake(str(tmp_path))
    held = quarantine({"fact_crop_yield": yields}, checks, lake)["fact_crop_yield"]
    assert sorted(r.fips for r in held.collect()) == ["190010", "190013"]
    assert {tuple(r.failed) for r in held.collect()} == {("yield_value",)}
    clean = quarantine({"fact_crop_yield": yields.where("yield_value = 180")}, checks, lake)
    assert clean["fact_crop_yield"].isEmpty()
    enforce_checks(run_checks({"fact_crop_yield": yields.where("yield_value IN (180, 200)")}, checks))


def test_rules_name_models_and_columns_that_exist():
    from agroweather import schemas

    tables = {"stg_weather_daily": schemas.STAGED_WEATHER, "fact_weather_daily": schemas.STAGED_WEATHER,
              "fact_crop_yield": schemas.CROP_YIELD, "int_weather_growing_season": schemas.SEASON_FEATURES,
              "weather_yield_analysis": schemas.ANALYSIS, "stg_nass_yield": schemas.CROP_YIELD}
    for model, rules in RULES.items():
        assert set(rules) <= set(tables[model].names)


# ---- freshness by the load logs


def test_source_freshness(spark, raw_yields, tmp_path):
    lake = Lake(str(tmp_path))
    limits = {"y": AgeLimits(timedelta(hours=1), timedelta(hours=3)), "z": AgeLimits(timedelta(1), timedelta(2))}

    def load(hour, replace="table"):
        op.land_bronze(raw_yields({"year": 2025, "_ingested_at": stamp(hour)}), lake.bronze("y"), "year")
        op.load_raw(spark, lake.bronze("y"), lake.raw("y"), RAW_YIELD, partition_by="year",
                    cluster_by=["state_alpha"], replace=replace, log_path=lake.loads("y"))

    def status(hour):
        return [(r.source, r.n_loads, r.age_seconds, r.status)
                for r in source_freshness(spark, lake, stamp(hour), limits).collect()]

    with pytest.raises(StaleSource, match="y: latest load None; z"):
        enforce_freshness(source_freshness(spark, lake, stamp(9), limits))
    load(8)
    assert status(9) == [("y", 1, 3600, "pass"), ("z", 0, None, "error")]
    assert status(11)[0] == ("y", 1, 3 * 3600, "warn")
    assert status(12)[0][3] == "error"
    only = {"y": limits["y"]}
    assert enforce_freshness(source_freshness(spark, lake, stamp(9), only)) == []
    assert enforce_freshness(source_freshness(spark, lake, stamp(10), only)) == ["y"]
    with pytest.raises(StaleSource, match="^y: "):
        enforce_freshness(source_freshness(spark, lake, stamp(12), only))
    load(7, "partitions")
    assert status(9)[0] == ("y", 2, 3600, "pass")
    load(6)  # replaces the table, so the earlier loads no longer count
    assert status(9)[0] == ("y", 1, 3 * 3600, "warn")


def test_freshness_reads_no_rows_of_raw(spark, tmp_path):
    lake = Lake(str(tmp_path))
    op.write_table(spark.range(1).selectExpr("5L AS n_rows", "TIMESTAMP'2026-01-01' AS latest"), lake.loads("y"))
    plan = source_freshness(spark, lake, stamp(9), {"y": AgeLimits(timedelta(1), timedelta(2))})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "/loads/y" in text and "/raw" not in text


# ---- reconciliation by content


def test_differing_groups(spark):
    left = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.0), (2, "a", 1.0), (3, "c", None), (None, "d", 1.0), (4, "x", 1.0)],
        "k int, s string, v double")
    same = left.orderBy("v", "s")
    assert rows(op.differing_groups(left, same, ["k"], ["s", "v"])) == []
    other = spark.createDataFrame(
        [(1, "a", 2.0), (1, "b", 1.0), (2, "a", 1.0), (3, "c", None), (None, "d", 1.5), (5, "y", 1.0)],
        "k int, s string, v double")
    got = sorted(rows(op.differing_groups(left, other, ["k"], ["s", "v"])), key=str)
    assert got == [(1, 2, 2), (2, 2, 1), (4, 1, 0), (5, 0, 1), (None, 1, 1)]
    assert rows(op.differing_groups(left.limit(0), left.limit(0), ["k"], ["s", "v"])) == []
