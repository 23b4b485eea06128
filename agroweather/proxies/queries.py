"""The registered queries: every operator and model over the whole proxy views."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agroweather import operators as op
from agroweather import plans
from agroweather.functions import bu_acre_to_t_ha, county_fips, parse_yield
from agroweather.operators import publish, sinks
from agroweather.operators.publish import REPLACE_PARTITIONS, REPLACE_TABLE
from agroweather.proxies import payloads, views
from agroweather.schemas import ANALYSIS, CROP_YIELD, RAW_WEATHER, RAW_YIELD, STAGED_WEATHER
from agroweather.session import configure, remove_folder, scratch_path
from agroweather.sources import (
    Lake,
    attach_points,
    parse_weather_payloads,
    parse_yield_payloads,
    read_centroids,
    read_payloads,
    read_table,
)

# Parameters shared with the oracles.
BATCH_SIZE = 33
RECORD_LIMIT = 5
PROBED_YEARS = [1994, 1995, 1998, 1999, 2002]
SPLIT_YEAR = 1998
INCREMENTAL_UNTIL = date(2000, 12, 31)
WINDOW = (date(1995, 1, 1), date(2001, 12, 31))
YIELD_YEAR = 1998
BACKFILL_YEARS = [1996, 1998]
YIELD_COMMODITIES = ["CORN", "SOYBEANS"]
GATE_COMMODITIES = ["CORN", "SOYBEANS", "WHEAT", "OATS"]
GATE_YEARS = list(range(1994, 2003))
STAMP = datetime(2026, 2, 1, 12, 0, 0, tzinfo=timezone.utc)
FRESHNESS_NOW = datetime(2026, 2, 1, 0, 0, 0, tzinfo=timezone.utc)
FRESHNESS_MAX_AGE = timedelta(days=30)
SEED_STATES = ["NATION_1", "NATION_6", "NATION_9", "NATION_11", "NATION_18"]
YIELD_STATES = [f"NATION_{key}" for key in range(25)]
YIELD_RANGE = (600.0, 2500.0)
TMAX_RANGE = (0.0, 40.0)
RULES = {
    "stg_weather_daily": {
        "temperature_2m_max": "temperature_2m_max BETWEEN 0 AND 40",
        "temperature_2m_min": "temperature_2m_min BETWEEN -10 AND 30",
    },
    "fact_crop_yield": {"yield_value": "yield_value BETWEEN 600 AND 2500"},
    "weather_yield_analysis": {
        "gdd": "gdd BETWEEN 1 AND 10000",
        "dry_and_hot": "NOT (heat_stress_days > 5 AND dry_days = 0)",
    },
}
COLOCATED_BUCKETS = 16
CUT_MONTH = 6
LATE_YEAR = 1996
TAMPERED_DAYS = [date(1996, 3, 1), date(1997, 7, 4), date(1998, 12, 31)]
LOAD_LIMITS = plans.AgeLimits(timedelta(days=12), timedelta(days=20))
LOAD_EPOCH = 1_596_000_000


def staged_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.stage_weather(views.raw_weather(spark, sf_dir))


def staged_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged weather in the order of the weather fact, for its writers."""
    return plans.stage_weather_in_order(views.raw_weather(spark, sf_dir), plans.FACT_ORDER)


def staged_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.stage_yields(views.raw_yields(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.season_features(staged_weather(spark, sf_dir))


def crop_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.crop_yield_fact(staged_yields(spark, sf_dir))


def county_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.county_dimension(views.counties(spark, sf_dir))


def commodity_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commodity dimension with the number of staged yields of each commodity."""
    used = (
        staged_yields(spark, sf_dir).groupBy("commodity").agg(F.count(F.lit(1)).alias("n_yields"))
    )
    return plans.commodity_dimension(spark).join(used, "commodity", "left")


def observed_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension over the days the weather table spans."""
    span = views.raw_weather(spark, sf_dir).agg(
        F.min("date").alias("first"), F.max("date").alias("last")
    )
    return plans.calendar(span, F.col("first"), F.col("last"))


def fact_weather_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Lake(scratch_path(spark, "fact-full")).mart("fact_weather_daily")
    plans.refresh_weather_fact(spark, staged_in_order(spark, sf_dir), path, placed=True)
    return read_table(spark, path, STAGED_WEATHER)


def fact_weather_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of earlier days, marked by a wind speed of -1, then one incremental build."""
    path = Lake(scratch_path(spark, "fact-incremental")).mart("fact_weather_daily")
    staged = staged_in_order(spark, sf_dir)
    earlier = staged.filter(F.col("date") <= F.lit(INCREMENTAL_UNTIL)).withColumn(
        "wind_speed_kmh", F.lit(-1.0)
    )
    plans.refresh_weather_fact(spark, earlier, path, placed=True)
    plans.refresh_weather_fact(spark, staged, path, placed=True)
    return read_table(spark, path, STAGED_WEATHER)


def fact_weather_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a first build left behind without its commit marker, then a build."""
    path = Lake(scratch_path(spark, "fact-recovered")).mart("fact_weather_daily")
    staged = staged_in_order(spark, sf_dir)
    plans.refresh_weather_fact(
        spark,
        staged.filter(F.month("date") == 6).withColumn("wind_speed_kmh", F.lit(-1.0)),
        path,
        placed=True,
    )
    remove_folder(spark, f"{path}/_SUCCESS")
    plans.refresh_weather_fact(spark, staged, path, placed=True)
    return read_table(spark, path, STAGED_WEATHER)


def fact_refresh_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh that was cut off when it had moved the days of one month only, then the next."""
    path = Lake(scratch_path(spark, "fact-cut")).mart("fact_weather_daily")
    staged = staged_in_order(spark, sf_dir)
    until = F.lit(INCREMENTAL_UNTIL)
    plans.refresh_weather_fact(spark, staged.filter(F.col("date") <= until), path, placed=True)
    later = staged.filter(F.col("date") >= op.high_watermark(spark, path))
    sinks.write_beside(later, path, "date", ["fips"], rebalance=False)
    publish.decide(spark, path, REPLACE_PARTITIONS)
    for folder in publish.partition_folders(spark, publish.incoming(path)):
        if date.fromisoformat(folder.removeprefix("date=")).month == CUT_MONTH:
            remove_folder(spark, f"{path}/{folder}")
            publish.move(spark, f"{publish.incoming(path)}/{folder}", f"{path}/{folder}")
    plans.refresh_weather_fact(spark, staged, path, placed=True)
    return read_table(spark, path, STAGED_WEATHER)


def fact_late_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loaded with the later years first; the fact then takes the window that came late."""
    lake = Lake(scratch_path(spark, "fact-late"))
    raw, path = views.raw_weather(spark, sf_dir), lake.raw("weather_daily")
    late = F.year("date") <= LATE_YEAR
    for days in (~late, late):  # raw holds one window at a time
        op.write_partitioned(raw.filter(days), path, "date", ["fips"])
        loaded = read_table(spark, path, RAW_WEATHER)
        plans.refresh_fact(
            spark,
            plans.stage_weather_in_order(loaded, plans.FACT_ORDER),
            loaded,
            lake,
            mode=plans.FACT_CHANGED,
            raw_path=path,
            placed=True,
        )
    return read_table(spark, lake.mart("fact_weather_daily"), STAGED_WEATHER)


def staging_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season features after a build on the earlier days and a refresh with the later ones."""
    lake = Lake(scratch_path(spark, "staging-refreshed"))
    raw, path = views.raw_weather(spark, sf_dir), lake.raw("weather_daily")
    earlier = F.col("date") <= F.lit(INCREMENTAL_UNTIL)
    for days, replace in ((earlier, REPLACE_TABLE), (~earlier, REPLACE_PARTITIONS)):
        op.write_partitioned(raw.filter(days), path, "date", ["fips"], replace)
        loaded = read_table(spark, path, RAW_WEATHER)
        _, found = plans.store_weather(spark, loaded, lake, raw_path=path)
    return found


def weather_yield_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.weather_yield_analysis(
        crop_yields(spark, sf_dir), features(spark, sf_dir), county_dimension(spark, sf_dir)
    )


def analysis_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart in its stored layout: partitioned by year, ordered by state and commodity."""
    path = Lake(scratch_path(spark, "analysis")).mart("weather_yield_analysis")
    mart = weather_yield_analysis(spark, sf_dir)
    op.write_partitioned(mart, path, "year", ["state_alpha", "commodity"])
    return read_table(spark, path, ANALYSIS)


def analysis_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart joined from features and yields stored by buckets of county and year."""
    path = scratch_path(spark, "colocated")
    lake, prefix = Lake(path), f"mart_{path[-32:]}_"
    plans.store_colocated(features(spark, sf_dir), crop_yields(spark, sf_dir), lake, COLOCATED_BUCKETS, prefix)
    stored = plans.open_colocated(spark, lake, COLOCATED_BUCKETS, prefix)
    return plans.colocated_analysis(*stored, county_dimension(spark, sf_dir))


def yield_unit_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw record, whatever its unit, statistic or commodity."""
    parsed = views.raw_yields(spark, sf_dir).withColumn(
        "yield_value", parse_yield(F.col("value_raw"))
    )
    return parsed.select(
        "state_fips_code",
        "county_code",
        "commodity_desc",
        "year",
        "value_raw",
        "yield_value",
        bu_acre_to_t_ha(F.col("yield_value"), F.col("commodity_desc")).alias("yield_value_t_ha"),
    )


def _landed_weather(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Stored point table, and the folder of landed JSON responses to its batches."""
    raw = views.raw_weather(spark, sf_dir)
    root = scratch_path(spark, "weather-payloads")
    payloads.weather_points(raw).write.parquet(f"{root}/points")
    points = spark.read.parquet(f"{root}/points")
    batches = op.point_batches(points, BATCH_SIZE)
    payloads.weather_payloads(raw, batches).write.partitionBy("batch_id").text(f"{root}/landed")
    return points, f"{root}/landed"


def parse_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, path = _landed_weather(spark, sf_dir)
    batches = plans.request_batches(points, scratch_path(spark, "point-batches"), BATCH_SIZE)
    landed = read_payloads(spark, path, "batch_id")
    return parse_weather_payloads(attach_points(landed, batches))


def _landed_yields(spark: SparkSession, sf_dir: str) -> str:
    path = f"{scratch_path(spark, 'yield-payloads')}/landed"
    payloads.yield_payloads(views.raw_yields(spark, sf_dir)).write.text(path)
    return path


def parse_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = read_payloads(spark, _landed_yields(spark, sf_dir), one_per_file=False)
    return parse_yield_payloads(landed)


def ingest_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(scratch_path(spark, "ingest-weather"))
    points, path = _landed_weather(spark, sf_dir)
    start, end = WINDOW
    plans.ingest_weather(
        spark,
        path,
        points,
        lake,
        start=start,
        end=end,
        batch_size=BATCH_SIZE,
        ingested_at=STAMP,
    )
    return read_table(spark, lake.raw("weather_daily"), RAW_WEATHER)


def _largest_cell(spark: SparkSession, sf_dir: str) -> int:
    """Records of the largest commodity, state and year that the yield load asks for."""
    asked = views.raw_yields(spark, sf_dir).filter(
        (F.col("year") == YIELD_YEAR)
        & (F.col("statisticcat_desc") == "YIELD")
        & F.col("commodity_desc").isin(YIELD_COMMODITIES)
    )
    return op.record_counts(asked).agg(F.coalesce(F.max("n_records"), F.lit(0))).head()[0]


def _yield_load(spark: SparkSession, landed: str, lake: Lake, limit: int, stamp: datetime) -> str:
    try:
        return plans.ingest_yield_if_new(
            spark,
            landed,
            lake,
            one_per_file=False,
            year=YIELD_YEAR,
            commodities=YIELD_COMMODITIES,
            states=YIELD_STATES,
            limit=limit,
            ingested_at=stamp,
        ).status
    except op.RecordLimitExceeded:
        return "refused"


def ingest_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load whose largest cell is one record below the gate's limit."""
    lake = Lake(scratch_path(spark, "ingest-yield"))
    landed = _landed_yields(spark, sf_dir)
    _yield_load(spark, landed, lake, _largest_cell(spark, sf_dir) + 1, STAMP)
    return read_table(spark, lake.raw("nass_yield"), RAW_YIELD)


def ingest_yield_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that the gate refuses, one that it lets pass, and one that finds the year loaded."""
    lake, landed = Lake(scratch_path(spark, "ingest-twice")), _landed_yields(spark, sf_dir)
    largest = _largest_cell(spark, sf_dir)
    statuses = [
        _yield_load(spark, landed, lake, largest + room, STAMP + timedelta(days=later))
        for later, room in ((0, 0), (0, 1), (1, 1))
    ]
    loaded = read_table(spark, lake.raw("nass_yield"), RAW_YIELD)
    return loaded.withColumn("statuses", F.lit(",".join(statuses)))


def backfill_two_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after backfills of two years one after the other, both kept."""
    root = scratch_path(spark, "backfill")
    lake, raw = Lake(f"{root}/lake"), views.raw_weather(spark, sf_dir)
    observed = views.counties(spark, sf_dir).join(raw.select("fips"), "fips", "left_semi")
    observed.write.parquet(f"{root}/points")
    points = spark.read.parquet(f"{root}/points")
    responses = payloads.weather_payloads(raw, op.point_batches(points, BATCH_SIZE))
    responses.write.partitionBy("batch_id").text(f"{root}/weather")
    landed = _landed_yields(spark, sf_dir)
    n_counties = views.raw_yields(spark, sf_dir).select("state_fips_code", "county_code").distinct().count()
    for year in BACKFILL_YEARS:
        _, models, _ = plans.backfill(
            spark,
            lake,
            weather_payloads=f"{root}/weather",
            yield_payloads=landed,
            points=points,
            weather_start=date(year, 1, 1),
            weather_end=date(year, 12, 31),
            year=year,
            replace=REPLACE_PARTITIONS,
            weather_options={"batch_size": BATCH_SIZE, "ingested_at": STAMP},
            yield_options={
                "one_per_file": False,
                "commodities": YIELD_COMMODITIES,
                "states": YIELD_STATES,
                "limit": 1 + n_counties,
                "ingested_at": STAMP,
            },
        )
    return models["weather_yield_analysis"]


def bronze_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yields landed twice side by side; an empty frame clears one of the folders only."""
    lake, raw = Lake(scratch_path(spark, "cleared")), views.raw_yields(spark, sf_dir)
    for name in ("kept", "cleared"):
        op.land_bronze(raw, lake.bronze(name), "year")
    op.land_bronze(raw.filter(F.lit(False)), lake.bronze("cleared"), "year")
    counts = [
        read_table(spark, lake.bronze(name), RAW_YIELD).agg(
            F.lit(name).alias("folder"), F.count(F.lit(1)).alias("n_rows")
        )
        for name in ("kept", "cleared")
    ]
    return counts[0].unionByName(counts[1])


def county_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "seed")
    payloads.write_gazetteer(views.counties(spark, sf_dir), f"{root}/gazetteer")
    plans.build_county_seed(spark, f"{root}/gazetteer", f"{root}/centroids", SEED_STATES)
    return read_centroids(spark, f"{root}/centroids")


def point_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = op.point_batches(views.counties(spark, sf_dir), BATCH_SIZE)
    return batches.select(
        "batch_id",
        F.size("fips_list").cast("bigint").alias("n_points"),
        F.array_join("fips_list", ",").alias("fips_text"),
        "latitudes",
        "longitudes",
    )


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(scratch_path(spark, "roundtrip"))
    op.land_bronze(views.raw_weather(spark, sf_dir), lake.bronze("weather_daily"), "date")
    op.load_raw(
        spark,
        lake.bronze("weather_daily"),
        lake.raw("weather_daily"),
        RAW_WEATHER,
        partition_by="date",
        cluster_by=["fips"],
    )
    return read_table(spark, lake.raw("weather_daily"), RAW_WEATHER)


def _load_yields(spark: SparkSession, window: DataFrame, lake: Lake, replace: str) -> None:
    op.land_bronze(window, lake.bronze("nass_yield"), "year")
    op.load_raw(
        spark,
        lake.bronze("nass_yield"),
        lake.raw("nass_yield"),
        RAW_YIELD,
        partition_by="year",
        cluster_by=["state_alpha", "commodity_desc"],
        replace=replace,
    )


def _two_windows(spark: SparkSession, sf_dir: str, replace: str) -> DataFrame:
    """Years up to the split, marked as first, then years from the split on."""
    lake = Lake(scratch_path(spark, f"windows-{replace}"))
    raw = views.raw_yields(spark, sf_dir)
    first = raw.filter(F.col("year") <= SPLIT_YEAR).withColumn("short_desc", F.lit("first"))
    _load_yields(spark, first, lake, replace)
    _load_yields(spark, raw.filter(F.col("year") >= SPLIT_YEAR), lake, replace)
    return read_table(spark, lake.raw("nass_yield"), RAW_YIELD)


def raw_yield_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_windows(spark, sf_dir, REPLACE_TABLE)


def raw_yield_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_windows(spark, sf_dir, REPLACE_PARTITIONS)


def year_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(scratch_path(spark, "year-loaded"))
    raw = views.raw_yields(spark, sf_dir)
    _load_yields(spark, raw.filter(F.col("year") <= SPLIT_YEAR), lake, REPLACE_TABLE)
    loaded = read_table(spark, lake.raw("nass_yield"), RAW_YIELD)
    result = op.year_probe(loaded, PROBED_YEARS[0])
    for year in PROBED_YEARS[1:]:
        result = result.unionByName(op.year_probe(loaded, year))
    return result


def record_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = op.work_list(views.states(spark, sf_dir), GATE_COMMODITIES, GATE_YEARS)
    return op.record_counts(views.raw_yields(spark, sf_dir), work, RECORD_LIMIT)


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.null_counts(staged_weather(spark, sf_dir), STAGED_WEATHER.names)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.duplicate_keys(views.raw_weather(spark, sf_dir), ["fips"], ignore_nulls=True)


def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.duplicate_keys(views.raw_weather(spark, sf_dir), ["fips", "date"])


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unexpected_values(staged_yields(spark, sf_dir), "commodity", ["corn", "soybeans"])


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.orphan_keys(
        crop_yields(spark, sf_dir), "fips", county_dimension(spark, sf_dir), "fips"
    )


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model built, then every declared check."""
    return plans.run_checks(_built(spark, sf_dir, Lake(scratch_path(spark, "suite"))))


def _built(spark: SparkSession, sf_dir: str, lake: Lake) -> dict[str, DataFrame]:
    return plans.build_models(
        spark,
        views.raw_weather(spark, sf_dir),
        views.raw_yields(spark, sf_dir),
        views.counties(spark, sf_dir),
        lake,
    )


def dq_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model built, then every declared check and every rule on single rows."""
    models = _built(spark, sf_dir, Lake(scratch_path(spark, "gated")))
    return plans.run_checks(models, plans.with_rules(plans.CHECKS, RULES))


def dq_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of the yields after the later years came in: earlier years keep their counts."""
    lake, staged = Lake(scratch_path(spark, "by-period")), staged_yields(spark, sf_dir)
    counties = county_dimension(spark, sf_dir)
    checks = {"fact_crop_yield": plans.CHECKS["fact_crop_yield"]}
    path = lake.mart("fact_crop_yield")
    earlier = F.col("year") <= SPLIT_YEAR
    for years, replace in ((earlier, REPLACE_TABLE), (~earlier, REPLACE_PARTITIONS)):
        op.write_partitioned(plans.crop_yield_fact(staged.where(years)), path, "year", ["state_alpha"], replace)
        models = {"fact_crop_yield": read_table(spark, path, CROP_YIELD), "dim_county": counties}
        found = plans.run_checks_by_period(spark, lake, models, checks)
    return found


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yields and weather days that a rule keeps out, with the rules they break."""
    lake = Lake(scratch_path(spark, "quarantine"))
    models = {
        "stg_weather_daily": staged_weather(spark, sf_dir),
        "fact_crop_yield": crop_yields(spark, sf_dir),
    }
    checks = plans.with_rules({name: plans.CHECKS[name] for name in models}, RULES)
    held = plans.quarantine(models, checks, lake)
    return held["stg_weather_daily"].select(
        "fips", F.col("date").cast("string").alias("period"), F.array_join("failed", ",").alias("failed")
    ).unionByName(
        held["fact_crop_yield"].select(
            "fips", F.concat_ws(" ", "commodity", "year").alias("period"), F.array_join("failed", ",").alias("failed")
        )
    )


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages by the load logs: yields loaded in two windows, the first of them alone, and nothing."""
    lake, raw = Lake(scratch_path(spark, "source-freshness")), views.raw_yields(spark, sf_dir)
    stamped = raw.withColumn("_ingested_at", F.timestamp_seconds(F.col("year") * 86400 + LOAD_EPOCH))
    for table, windows in (("both", (True, False)), ("first", (True,))):
        for early in windows:
            window = stamped.filter((F.col("year") <= SPLIT_YEAR) == early)
            op.land_bronze(window, lake.bronze(table), "year")
            op.load_raw(
                spark,
                lake.bronze(table),
                lake.raw(table),
                RAW_YIELD,
                partition_by="year",
                cluster_by=["state_alpha", "commodity_desc"],
                replace=REPLACE_PARTITIONS,
                log_path=lake.loads(table),
            )
    limits = dict.fromkeys(["both", "first", "none"], LOAD_LIMITS)
    return plans.source_freshness(spark, lake, FRESHNESS_NOW, limits)


def reconcile_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the stored fact whose rows are no longer those of staging; all counts agree."""
    path = Lake(scratch_path(spark, "content")).mart("fact_weather_daily")
    staged = staged_weather(spark, sf_dir)
    least = F.min("fips").over(Window.partitionBy("date"))
    tampered = F.when(
        F.col("date").isin(TAMPERED_DAYS) & (F.col("fips") == least), F.col("wind_speed_kmh") + 0.25
    ).otherwise(F.col("wind_speed_kmh"))
    op.write_table(staged.withColumn("wind_speed_kmh", tampered), path)
    fact = read_table(spark, path, STAGED_WEATHER)
    return op.differing_groups(staged, fact, ["date"], STAGED_WEATHER.names)


def dq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = op.out_of_range(crop_yields(spark, sf_dir), "yield_value", *YIELD_RANGE)
    return failing.select("fips", "commodity", "year", "yield_value")


def dq_weather_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = op.out_of_range(staged_weather(spark, sf_dir), "temperature_2m_max", *TMAX_RANGE)
    return failing.select("fips", "date", "temperature_2m_max")


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.freshness(
        views.raw_weather(spark, sf_dir), "_ingested_at", FRESHNESS_NOW, FRESHNESS_MAX_AGE
    )


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_weather(spark, sf_dir)
    return op.reconcile({"raw": raw, "staging": plans.stage_weather(raw)}, ["fips", "date"])


def reconcile_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yields from bronze over raw to staging, by county, commodity and year."""
    lake = Lake(scratch_path(spark, "layers"))
    _load_yields(spark, views.raw_yields(spark, sf_dir), lake, REPLACE_TABLE)
    key = [
        county_fips(F.col("state_fips_code"), F.col("county_code")).alias("fips"),
        F.lower("commodity_desc").alias("commodity"),
        "year",
    ]
    bronze = read_table(spark, lake.bronze("nass_yield"), RAW_YIELD)
    raw = read_table(spark, lake.raw("nass_yield"), RAW_YIELD)
    layers = {"bronze": bronze.select(*key), "raw": raw.select(*key), "staging": plans.stage_yields(raw)}
    return op.reconcile(layers, ["fips", "commodity", "year"])


def state_yield_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.state_yields(crop_yields(spark, sf_dir))


def weather_yield_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = plans.weather_yield_correlation(weather_yield_analysis(spark, sf_dir))
    return found.withColumn("correlation", F.round("correlation", 6))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_stg_weather_daily": staged_weather,
    "q_stg_nass_yield": staged_yields,
    "q_int_weather_growing_season": features,
    "q_dim_county": county_dimension,
    "q_dim_commodity": commodity_usage,
    "q_dim_date": observed_calendar,
    "q_fact_weather_full": fact_weather_full,
    "q_fact_weather_incremental": fact_weather_incremental,
    "q_fact_crop_yield": crop_yields,
    "q_weather_yield_analysis": weather_yield_analysis,
    "q_analysis_table": analysis_table,
    "q_analysis_colocated": analysis_colocated,
    "q_yield_unit_conversion": yield_unit_conversion,
    "q_parse_weather_payload": parse_weather,
    "q_parse_yield_payload": parse_yields,
    "q_ingest_weather": ingest_weather,
    "q_ingest_yield": ingest_yield,
    "q_build_county_seed": county_seed,
    "q_point_batches": point_batches,
    "q_bronze_roundtrip": bronze_roundtrip,
    "q_raw_yield_replace": raw_yield_replace,
    "q_raw_yield_partitions": raw_yield_partitions,
    "q_year_loaded": year_loaded,
    "q_record_count_gate": record_count_gate,
    "q_fact_weather_recovered": fact_weather_recovered,
    "q_fact_refresh_recovered": fact_refresh_recovered,
    "q_backfill_fact": fact_late_window,
    "q_staging_refreshed": staging_refreshed,
    "q_ingest_yield_twice": ingest_yield_twice,
    "q_bronze_cleared": bronze_cleared,
    "q_dq_not_null": dq_not_null,
    "q_dq_unique": dq_unique,
    "q_dq_unique_combination": dq_unique_combination,
    "q_dq_accepted_values": dq_accepted_values,
    "q_dq_relationships": dq_relationships,
    "q_dq_suite": dq_suite,
    "q_dq_gated": dq_gated,
    "q_dq_by_period": dq_by_period,
    "q_dq_quarantine": dq_quarantine,
    "q_dq_ranges": dq_ranges,
    "q_dq_weather_ranges": dq_weather_ranges,
    "q_freshness": freshness,
    "q_source_freshness": source_freshness,
    "q_reconcile": reconcile,
    "q_reconcile_content": reconcile_content,
    "q_reconcile_layers": reconcile_layers,
    "q_backfill_two_windows": backfill_two_windows,
    "q_state_yield_rollup": state_yield_rollup,
    "q_weather_yield_corr": weather_yield_corr,
}


def configured(
    query: Callable[[SparkSession, str], DataFrame],
) -> Callable[[SparkSession, str], DataFrame]:
    """The query, after the given session has got the settings of the library."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run
