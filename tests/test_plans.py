"""Plan shapes: what is pushed down, shuffled, broadcast and split."""

import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from agroweather import operators as op
from agroweather import plans
from agroweather.operators import sinks
from agroweather.plans import refresh
from agroweather.plans.ingestion import STATES
from agroweather.proxies import payloads
from agroweather.sources.constants import constant_rows
from agroweather.functions import in_season
from agroweather.schemas import RAW_WEATHER, STAGED_WEATHER
from agroweather.session import configure
from agroweather.sources import Lake, attach_points, parse_weather_payloads, parse_yield_payloads, read_table
from tests.conftest import day, stamp


@contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return plan(df)


@pytest.fixture
def stored_weather(spark, raw_weather, tmp_path):
    path = str(tmp_path / "raw")
    made = [
        {"fips": f, "date": day(d), "temperature_2m_max": 20.0, "temperature_2m_min": 10.0,
         "_ingested_at": stamp(8)}
        for f in ("31055", "31057") for d in ("2025-03-01", "2025-05-01", "2025-06-01")
    ]
    op.write_partitioned(raw_weather(*made), path, "date", ["fips"])
    return read_table(spark, path, RAW_WEATHER)


def test_copies_are_dropped_before_the_shuffle(stored_weather):
    text = plan(plans.stage_weather(stored_weather))
    below_shuffle = text[text.index("Exchange hashpartitioning(fips"):]
    assert re.search(r"WindowGroupLimit .* Partial", below_shuffle)
    assert text.count("Exchange") == 1


def test_rows_staged_in_order_are_shuffled_and_sorted_once(stored_weather):
    staged = plans.stage_weather_in_order(stored_weather, plans.FACT_ORDER)
    text = plan(staged.sortWithinPartitions(*plans.FACT_ORDER))
    assert text.count("Exchange") == 1 and "Exchange rangepartitioning(date" in text
    assert len(re.findall(r"\bSort \[", text)) == 1
    newer = plan(staged.filter(F.col("date") >= F.lit(day("2025-05-01"))))
    assert ">= 2025-05-01" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", newer).group(1)


def test_rows_staged_in_order_are_those_of_staging(raw_weather):
    made = [
        {"fips": f, "date": d and day(d), "temperature_2m_max": t, "_ingested_at": s and stamp(s)}
        for f in ("31055", None) for d in ("2025-05-01", None) for t in (None, 20.0) for s in (None, 8, 8, 9)
    ]
    raw = raw_weather(*made)
    staged = plans.stage_weather_in_order(raw, plans.FACT_ORDER)
    assert sorted(map(str, staged.collect())) == sorted(map(str, plans.stage_weather(raw).collect()))
    assert staged.count() == 4


def test_staged_months_are_shuffled_and_sorted_once(stored_weather, monkeypatch):
    written = []

    def write(df, path, by, cluster_by, replace, rebalance=True, drop=()):
        written.append((plan(df.sortWithinPartitions(by, *cluster_by)), rebalance))

    monkeypatch.setattr(refresh, "write_partitioned", write)
    refresh._write_staged(stored_weather, "staged", "table")
    [(text, rebalance)] = written
    assert not rebalance
    assert text.count("Exchange") == 1 and "Exchange rangepartitioning(month" in text
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_payload_days_are_placed_by_county_once(stored_weather):
    batches = stored_weather.sparkSession.createDataFrame(
        [(0, ["31055", "31057"])], "batch_id bigint, fips_list array<string>"
    )
    text = plan(payloads.weather_payloads(stored_weather, batches))
    assert "hashpartitioning(fips, date" not in text and "hashpartitioning(fips#" in text
    assert "hashpartitioning(fips, latitude" not in text
    assert not re.search(r"hashpartitioning\(fips#\d+, [a-z]", text)


def test_few_tasks_list_the_folders_of_a_table(spark):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    for given, kept in (("10000", "64"), ("4", "4")):
        with settings(spark, **{key.replace(".", "__"): given}):
            assert configure(spark).conf.get(key) == kept


def test_season_filter_prunes_partitions_below_the_window(stored_weather):
    features = plans.season_features(plans.stage_weather(stored_weather))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(features)).group(1)
    assert "month(" in filters
    assert "latitude" not in re.search(r"ReadSchema: (.*)", plan(features)).group(1)
    assert features.count() == 2


def test_incremental_filter_prunes_partitions_below_the_window(stored_weather):
    newer = plans.stage_weather(stored_weather).filter(F.col("date") >= F.lit(day("2025-05-01")))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(newer)).group(1)
    assert ">= 2025-05-01" in filters


def test_yield_filters_reach_the_scan(spark, raw_yields, tmp_path):
    path = str(tmp_path / "yields")
    raw_yields({}).write.parquet(path)
    text = plan(plans.stage_yields(spark.read.parquet(path)))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in ("statisticcat_desc,YIELD", "unit_desc,BU / ACRE", "In(county_code"):
        assert part in pushed
    assert "Exchange" not in text and "county_name" not in text


def _tables(spark, path, n_yields, n_counties=40, hot=0):
    """Yields with ``hot`` extra rows on one county and year, features, counties."""
    code = F.format_string("19%03d", (F.col("id") % n_counties).cast("int"))
    counties = spark.range(n_counties).select(
        code.alias("fips"), F.lit("IA").alias("state_alpha"), F.lit("c").alias("county_name"))
    staged = spark.range(n_counties * 20).select(
        code.alias("fips"),
        F.date_add(F.lit(day("2025-05-01")), (F.col("id") / n_counties).cast("int")).alias("date"),
        *[F.lit(1.0).alias(c) for c in STAGED_WEATHER.names[2:9]],
        F.lit(stamp(8)).alias("_ingested_at"),
    )
    yields = spark.range(n_yields).select(code.alias("fips"), F.col("id").alias("row")).unionByName(
        spark.range(hot).select(F.lit("19007").alias("fips"), F.col("id").alias("row"))
    ).select(
        "fips", F.concat(F.lit("corn"), F.sha2(F.col("row").cast("string"), 256)).alias("commodity"),
        F.lit("IA").alias("state_alpha"), F.lit(2025).cast("bigint").alias("year"),
        F.lit(1.0).alias("yield_value"), F.lit(1.0).alias("yield_value_t_ha"),
        F.lit("BU / ACRE").alias("unit"), F.lit(stamp(8)).alias("_ingested_at"),
    )
    out = {}
    for name, df in {"counties": counties, "staged": staged, "yields": yields}.items():
        df.repartition(6).write.parquet(f"{path}/{name}")
        out[name] = spark.read.parquet(f"{path}/{name}")
    return out["yields"], plans.season_features(out["staged"]), out["counties"]


def test_small_sides_are_broadcast_by_measured_size(spark, tmp_path):
    mart = plans.weather_yield_analysis(*_tables(spark, str(tmp_path), 200))
    assert "BroadcastHashJoin" in executed(mart)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        mart = plans.weather_yield_analysis(*_tables(spark, str(tmp_path / "b"), 200))
        text = executed(mart)
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_hot_county_year_is_split_over_tasks(spark, tmp_path):
    """One county and year holds most yields: its join partition is split, no row is lost."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
    ):
        mart = plans.weather_yield_analysis(*_tables(spark, str(tmp_path), 400, hot=20000))
        assert "skew=true" in executed(mart)
        assert mart.count() == 20400
        assert mart.select("commodity").distinct().count() == 20000


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    """Below the mart's join stand scans only, also for tables declared anew; one county's years lie in many buckets."""
    yields, features, counties = _tables(spark, str(tmp_path / "in"), 400)
    lake = Lake(str(tmp_path / "lake"))
    want = sorted(map(str, plans.weather_yield_analysis(yields, features, counties).collect()))
    assert len(want) >= 400
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        stored = plans.store_colocated(features, yields, lake, 8, "first_")
        again = plans.open_colocated(spark, lake, 8, "second_")
        for pair in (stored, again):
            mart = plans.colocated_analysis(*pair, F.broadcast(counties))
            text = executed(mart)
            assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text
            assert sorted(map(str, mart.collect())) == want
    one = spark.range(40).select(F.lit("00001").alias("fips"), F.col("id").alias("year"))
    spread = op.write_bucketed(one, "one_county", str(tmp_path / "one"), ["fips", "year"], 8)
    assert spread.select(F.input_file_name().alias("file")).distinct().count() > 4
    assert [op.bucket_count(n, 100) for n in (0, 100, 101, 250, 900)] == [1, 1, 2, 4, 16]


def test_hot_day_is_split_over_files(spark, tmp_path):
    """One day holds most rows: its partition is written by several tasks."""
    made = spark.range(40000).select(
        F.format_string("%05d", (F.col("id") % 1000).cast("int")).alias("fips"),
        F.when(F.col("id") % 10 == 0, F.lit(day("2025-04-02"))).otherwise(
            F.lit(day("2025-04-01"))).alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("body"),
    ).repartition(6)
    path = str(tmp_path / "t")
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="300k"):
        op.write_partitioned(made, path, "date", ["fips"])
    hot = [n for n in os.listdir(f"{path}/date=2025-04-01") if n.endswith(".parquet")]
    assert len(hot) > 3
    assert spark.read.parquet(path).count() == 40000


def test_one_county_is_read_from_the_files_that_may_hold_it(spark, tmp_path, monkeypatch):
    """A day split over files that all span the counties: Bloom filters tell them apart."""
    made = spark.range(8000).select(
        F.format_string("%05d", (F.col("id") * 7919 % 8000).cast("int")).alias("fips"),
        F.lit(day("2025-04-01")).alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("body"),
    ).repartition(8, "fips")

    def scanned(path):
        found = spark.read.parquet(path).where("fips = '04321'")
        assert len(found.collect()) == 1
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return scan.metrics().apply("numOutputRows").value()

    op.write_partitioned(made, str(tmp_path / "with"), "date", ["fips"], rebalance=False)
    monkeypatch.setattr(sinks, "LOOKED_UP", {})
    op.write_partitioned(made, str(tmp_path / "without"), "date", ["fips"], rebalance=False)
    assert scanned(str(tmp_path / "with")) < 3000 < 7000 < scanned(str(tmp_path / "without"))


def test_orphan_check_shuffles_counted_keys(spark, tmp_path):
    """With a parent too large to broadcast, child keys are counted before they are shuffled."""
    yields, _, counties = _tables(spark, str(tmp_path), 200)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        text = plan(op.orphan_keys(yields, "fips", counties))
        assert text.index("LeftAnti") < text.index("HashAggregate")
    assert "BroadcastHashJoin" in plan(op.orphan_keys(yields, "fips", counties))


def test_point_lists_are_stored_once_and_joined_by_size(spark, tmp_path):
    spark.range(300).select(
        F.format_string("19%03d", F.col("id").cast("int")).alias("fips"),
        F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"),
    ).write.parquet(str(tmp_path / "points"))
    points = spark.read.parquet(str(tmp_path / "points"))
    bodies = spark.range(6).select(F.col("id").alias("batch_id"), F.lit("{}").alias("body"))
    batches = plans.request_batches(points, str(tmp_path / "batches"), 50)
    joined = attach_points(bodies, batches)
    few = sorted(joined.collect(), key=str)
    assert "BroadcastHashJoin [batch_id" in plan(joined) and "Window" not in plan(joined)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        joined = attach_points(bodies, batches)
        assert "SortMergeJoin [batch_id" in plan(joined)
        assert few == sorted(joined.collect(), key=str)


def test_constant_relations_are_known_to_be_small(spark, tmp_path, raw_yields):
    raw_yields({}).write.parquet(str(tmp_path / "yields"))
    yields = spark.read.parquet(str(tmp_path / "yields"))
    with settings(spark, spark__sql__adaptive__enabled="false"):
        by_name = yields.withColumn("commodity", F.lower("commodity_desc"))
        assert "BroadcastHashJoin" in plan(by_name.join(plans.commodity_dimension(spark), "commodity"))
        states = constant_rows(spark, [("NE",), ("IL",)], STATES)
        cells = op.work_list(states, ["CORN"], [2025])
        assert "SortMergeJoin" not in plan(op.record_counts(yields, cells, 9))


def test_no_python_runs_in_the_workers(spark, raw_weather, raw_yields):
    batches = spark.createDataFrame([("31055", 1.0, 2.0)], "fips string, lat double, lon double")
    bodies = spark.createDataFrame([(["31055"], "{}")], "fips_list array<string>, body string")
    for df in (
        plans.season_features(plans.stage_weather(raw_weather())),
        plans.stage_yields(raw_yields()),
        op.point_batches(batches),
        parse_weather_payloads(bodies),
        parse_yield_payloads(bodies),
    ):
        assert "Python" not in plan(df) and "ArrowEval" not in plan(df)


def test_season_test_stays_in_generated_code(spark):
    df = spark.range(10).filter(in_season(F.date_add(F.lit(day("2025-01-01")), F.col("id").cast("int"))))
    assert "*(1)" in executed(df)
