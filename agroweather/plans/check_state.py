"""The declared checks kept up to date by partition.

Where the key of a model holds its partition's period (a day's month, a year), a
repeated key lies within one period, and all other checks are counts. So the
counts of a period (:func:`~agroweather.plans.catalog.value_counts`) are stored
by period; a later run counts anew only the periods whose files changed, adds the
stored counts up and joins the sums to the parents, which may have changed
meanwhile. A period is known by its files, as in :mod:`agroweather.plans.refresh`.

A model's ledger (the files seen and the checks declared then) is written last:
after an interruption the next run finds the same periods changed. Other
declared checks, or a table without a finished state, are counted in full.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroweather.operators.publish import REPLACE_PARTITIONS, REPLACE_TABLE, recover
from agroweather.operators.sinks import write_partitioned, write_table
from agroweather.plans.catalog import (
    CHECKS,
    ModelChecks,
    merged_counts,
    one_pass_key,
    results_of,
    run_checks,
    value_counts,
)
from agroweather.plans.ingestion import YIELD_TABLE
from agroweather.plans.refresh import FEATURES, MONTH, STAGED, STAGED_BY_MONTH, among, changes, folder_files
from agroweather.session import remove_folder
from agroweather.sources.lake import Lake, is_committed, read_table, table_or_none

PERIOD = "period"
FILES_SCHEMA = "period string, files long, digest long"
LEDGER_SCHEMA = f"{FILES_SCHEMA}, declared string"


@dataclass(frozen=True)
class Stored:
    """A model's rows, the folder whose files tell what changed, and its partition column.

    ``monthly``: the column holds dates, and months are the periods.
    """

    rows: DataFrame
    path: str
    column: str
    monthly: bool = False

    @property
    def period(self) -> Column:
        value = F.trunc(self.column, "month") if self.monthly else F.col(self.column)
        return value.cast("string")


def stored_models(spark: SparkSession, lake: Lake, models: dict[str, DataFrame]) -> dict[str, Stored]:
    """The models whose key holds the period of their partitions."""
    staged = lake.staging(STAGED)
    places = {
        "stg_nass_yield": (lake.raw(YIELD_TABLE), "year", False),
        FEATURES: (lake.staging(FEATURES), "year", False),
        "fact_weather_daily": (lake.mart("fact_weather_daily"), "date", True),
        "fact_crop_yield": (lake.mart("fact_crop_yield"), "year", False),
        "weather_yield_analysis": (lake.mart("weather_yield_analysis"), "year", False),
    }
    found = {
        name: Stored(models[name], *place)
        for name, place in places.items()
        if name in models and is_committed(spark, place[0])
    }
    if STAGED in models and is_committed(spark, staged):
        found[STAGED] = Stored(read_table(spark, staged, STAGED_BY_MONTH), staged, MONTH, True)
    return found


def refresh_counts(
    spark: SparkSession, lake: Lake, name: str, checks: ModelChecks, key: list[str], stored: Stored
) -> DataFrame:
    """The stored counts of a model by period, brought up to date with its files."""
    state_path, ledger_path = lake.path("checks", name), lake.path("checks", f"{name}_ledger")
    seen_path = lake.path("checks", f"{name}_seen")
    for path in (state_path, ledger_path):
        recover(spark, path)
    write_table(folder_files(spark, stored.path, stored.column, stored.period), seen_path)
    seen = spark.read.schema(FILES_SCHEMA).parquet(seen_path)
    declared = json.dumps(asdict(checks), sort_keys=True)

    def counts(rows: DataFrame) -> DataFrame:
        return value_counts(rows, checks, key, {PERIOD: stored.period})

    ledger = table_or_none(spark, ledger_path, LEDGER_SCHEMA)
    current = ledger is not None and is_committed(spark, state_path)
    if current and not ledger.where(F.col("declared") != declared).head(1):
        periods = [row.period for row in changes(seen, ledger, PERIOD).collect()]
        if periods:
            changed = counts(stored.rows.where(among(stored.period, periods)))
            drop = [f"{PERIOD}={'__HIVE_DEFAULT_PARTITION__' if p is None else p}" for p in periods]
            write_partitioned(changed, state_path, PERIOD, replace=REPLACE_PARTITIONS, drop=drop)
    else:
        remove_folder(spark, ledger_path)  # until the state is whole again
        periods = None
        write_partitioned(counts(stored.rows), state_path, PERIOD, replace=REPLACE_TABLE)
    if periods is None or periods:
        write_table(seen.withColumn("declared", F.lit(declared)), ledger_path)
    return spark.read.schema(counts(stored.rows).schema).parquet(state_path)


def run_checks_by_period(
    spark: SparkSession,
    lake: Lake,
    models: dict[str, DataFrame],
    checks: dict[str, ModelChecks] | None = None,
) -> DataFrame:
    """The result of :func:`run_checks`, scanning only the periods that changed since the last run.

    The models are those of :func:`build_warehouse` or :func:`open_models` for this
    lake. Models without periods (the dimensions, lazy views) are checked in full.
    """
    checks = checks or CHECKS
    stored = stored_models(spark, lake, models)
    results = []
    for name, declared in checks.items():
        key = one_pass_key(declared)
        if key and name in stored:
            counted = refresh_counts(spark, lake, name, declared, key, stored[name])
            merged = merged_counts(counted, declared)
            results.append(results_of(name, declared, key, merged, models.__getitem__))
        else:
            results.append(run_checks(models, {name: declared}))
    return reduce(DataFrame.unionByName, results)
