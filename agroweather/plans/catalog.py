"""The declared checks of every model and the runner that applies them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroweather.operators.checks import (
    broken_rules,
    duplicate_keys,
    null_counts,
    orphan_keys,
    unexpected_values,
)
from agroweather.operators.sinks import write_table
from agroweather.sources.lake import Lake, read_table


class ChecksFailed(RuntimeError):
    """At least one declared check has failing rows."""


@dataclass(frozen=True)
class ModelChecks:
    """What has to hold for one model.

    ``not_null`` and ``unique`` list columns, ``unique_together`` is a key,
    ``accepted`` maps a column to its values, ``references`` maps a column to
    its parent ``(model, column)``, ``holds`` maps a name to a condition on a row
    (SQL); a row for which it is neither true nor false passes.
    """

    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    unique_together: list[str] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    holds: dict[str, str] = field(default_factory=dict)

    def __len__(self) -> int:
        return (
            len(self.not_null)
            + len(self.unique)
            + bool(self.unique_together)
            + len(self.accepted)
            + len(self.references)
            + len(self.holds)
        )


# The commodities in scope.
COMMODITY_NAMES = ["corn", "soybeans"]

# The declared checks, by model.
CHECKS = {
    "stg_weather_daily": ModelChecks(
        not_null=[
            "fips",
            "date",
            "temperature_2m_max",
            "temperature_2m_min",
            "precipitation_sum",
            "et0_fao_evapotranspiration",
            "solar_radiation_mjm2",
            "_ingested_at",
        ],
        unique_together=["fips", "date"],
    ),
    "stg_nass_yield": ModelChecks(
        not_null=["fips", "commodity", "state_alpha", "year", "_ingested_at"],
        unique_together=["fips", "commodity", "year"],
        accepted={"commodity": COMMODITY_NAMES},
    ),
    "int_weather_growing_season": ModelChecks(
        not_null=["fips", "year", "gdd", "precip_total_mm"],
        unique_together=["fips", "year"],
    ),
    "dim_county": ModelChecks(
        not_null=["fips", "state_alpha", "county_name", "lat", "lon"],
        unique=["fips"],
    ),
    "dim_commodity": ModelChecks(
        not_null=["commodity", "display_name", "gdd_base_c", "bushel_weight_lb"],
        unique=["commodity"],
        accepted={"commodity": COMMODITY_NAMES},
    ),
    "dim_date": ModelChecks(
        not_null=["date", "year", "month", "day", "day_of_year", "is_growing_season"],
        unique=["date"],
    ),
    "fact_weather_daily": ModelChecks(
        not_null=[
            "fips",
            "date",
            "temperature_2m_max",
            "temperature_2m_min",
            "precipitation_sum",
            "_ingested_at",
        ],
        unique_together=["fips", "date"],
        references={"fips": ("dim_county", "fips")},
    ),
    "fact_crop_yield": ModelChecks(
        not_null=["fips", "commodity", "state_alpha", "year", "unit", "_ingested_at"],
        unique_together=["fips", "commodity", "year"],
        accepted={"commodity": COMMODITY_NAMES},
        references={"fips": ("dim_county", "fips")},
    ),
    "weather_yield_analysis": ModelChecks(
        not_null=[
            "fips",
            "state_alpha",
            "county_name",
            "commodity",
            "year",
            "unit",
            "gdd",
            "precip_total_mm",
            "heat_stress_days",
            "dry_days",
            "et0_total_mm",
            "tmax_mean",
        ],
        unique_together=["fips", "commodity", "year"],
        references={
            "fips": ("dim_county", "fips"),
            "commodity": ("dim_commodity", "commodity"),
        },
    ),
}


# Plausible ranges of a row's measures, by model; beyond the declared checks.
_WEATHER_RULES = {
    "temperature_2m_max": "temperature_2m_max BETWEEN -60 AND 60",
    "temperature_2m_min": "temperature_2m_min BETWEEN -60 AND 60",
    "precipitation_sum": "precipitation_sum BETWEEN 0 AND 2000",
}
_SEASON_RULES = {
    "gdd": "gdd BETWEEN 0 AND 10000",
    "precip_total_mm": "precip_total_mm BETWEEN 0 AND 20000",
}
RULES = {
    "stg_weather_daily": _WEATHER_RULES,
    "fact_weather_daily": _WEATHER_RULES,
    "stg_nass_yield": {"yield_value": "yield_value BETWEEN 0 AND 400"},
    "fact_crop_yield": {"yield_value": "yield_value BETWEEN 0 AND 400"},
    "int_weather_growing_season": _SEASON_RULES,
    "weather_yield_analysis": {**_SEASON_RULES, "yield_value": "yield_value BETWEEN 0 AND 400"},
}


def with_rules(
    checks: dict[str, ModelChecks], rules: dict[str, dict[str, str]] | None = None
) -> dict[str, ModelChecks]:
    """The declared checks with conditions on single rows added (``RULES`` by default)."""
    rules = RULES if rules is None else rules
    return {name: replace(declared, holds=rules.get(name, {})) for name, declared in checks.items()}


def _result(failures: DataFrame, model: str, check: str, target: str) -> DataFrame:
    return failures.select(
        F.lit(model).alias("model"),
        F.lit(check).alias("check_name"),
        F.lit(target).alias("target"),
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"),
    )


def _failing_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("failures"))


def _failing_records(rows: DataFrame) -> DataFrame:
    return rows.agg(F.sum("n_records").alias("failures"))


def one_pass_key(checks: ModelChecks) -> list[str] | None:
    """The one key that covers a model's other checks, so that one grouping answers all of them."""
    keys = [checks.unique_together] if checks.unique_together else []
    keys += [[column] for column in checks.unique]
    if len(keys) == 1 and {*checks.accepted, *checks.references} <= set(keys[0]):
        return keys[0]
    return None


def _by_value(checks: ModelChecks) -> list[str]:
    return list(dict.fromkeys([*checks.accepted, *checks.references]))


def _sums(checks: ModelChecks) -> list[str]:
    return [f"__nulls_{i}" for i in range(len(checks.not_null))] + [
        f"__broken_{i}" for i in range(len(checks.holds))
    ]


def value_counts(
    df: DataFrame, checks: ModelChecks, key: list[str], within: dict[str, Column] | None = None
) -> DataFrame:
    """Rows, NULLs, broken rules and repeated keys per value of the columns that have
    accepted values or a parent.

    The rows of a key are counted before the one large shuffle. ``within`` names
    further groups; a key lies in one of them, so that counts of several groups add up.
    """
    within = within or {}
    counted = [F.count_if(F.col(column).isNull()) for column in checks.not_null]
    counted += [F.count_if(~F.expr(rule)) for rule in checks.holds.values()]
    duplicate = F.col("__n") > 1
    if not checks.unique_together:  # a single column, whose NULLs pass
        duplicate &= F.col(key[0]).isNotNull()
    return (
        df.groupBy(*key, *[column.alias(name) for name, column in within.items()])
        .agg(
            F.count(F.lit(1)).alias("__n"),
            *[count.alias(name) for name, count in zip(_sums(checks), counted, strict=True)],
        )
        .groupBy(*within, *_by_value(checks))
        .agg(
            F.count_if(duplicate).alias("__duplicates"),
            F.sum("__n").alias("__n"),
            *[F.sum(name).alias(name) for name in _sums(checks)],
        )
    )


def merged_counts(counted: DataFrame, checks: ModelChecks) -> DataFrame:
    """The :func:`value_counts` of several groups as those of all their rows."""
    sums = ["__duplicates", "__n", *_sums(checks)]
    return counted.groupBy(*_by_value(checks)).agg(*[F.sum(name).alias(name) for name in sums])


def results_of(
    name: str,
    checks: ModelChecks,
    key: list[str],
    counted: DataFrame,
    model: Callable[[str], DataFrame],
) -> DataFrame:
    """Every check of a model from its :func:`value_counts`; only these meet the parents."""
    for i, (column, (parent, parent_column)) in enumerate(checks.references.items()):
        known = (
            model(parent)
            .select(F.col(parent_column).alias(column))
            .dropna()
            .distinct()
            .withColumn(f"__known_{i}", F.lit(True))
        )
        counted = counted.join(known, column, "left")

    failures = [("not_null", column, F.sum(f"__nulls_{i}")) for i, column in enumerate(checks.not_null)]
    failures += [("holds", rule, F.sum(f"__broken_{i}")) for i, rule in enumerate(checks.holds)]
    kind = "unique_combination" if checks.unique_together else "unique"
    failures.append((kind, ",".join(key), F.sum("__duplicates")))
    for column, values in checks.accepted.items():
        unexpected = F.when(~F.col(column).isin(values), F.col(column))
        failures.append(("accepted_values", column, F.count_distinct(unexpected)))
    for i, column in enumerate(checks.references):
        orphan = F.col(column).isNotNull() & F.col(f"__known_{i}").isNull()
        failures.append(("relationships", column, F.sum(F.when(orphan, F.col("__n")))))
    totals = counted.agg(*[total.alias(f"__{i}") for i, (_, _, total) in enumerate(failures)])
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.lit(check).alias("check_name"),
            F.lit(target).alias("target"),
            F.coalesce(F.col(f"__{i}"), F.lit(0)).cast("bigint").alias("failures"),
        )
        for i, (check, target, _) in enumerate(failures)
    ]
    return totals.select(F.inline(F.array(*rows)))


def _pass_per_check(
    name: str, checks: ModelChecks, model: Callable[[str], DataFrame]
) -> list[DataFrame]:
    df = model(name)
    results = []
    if checks.not_null:
        results.append(
            null_counts(df, checks.not_null).select(
                F.lit(name).alias("model"),
                F.lit("not_null").alias("check_name"),
                F.col("column_name").alias("target"),
                "failures",
            )
        )
    for column in checks.unique:
        rows = duplicate_keys(df, [column], ignore_nulls=True)
        results.append(_result(_failing_rows(rows), name, "unique", column))
    if checks.unique_together:
        rows = duplicate_keys(df, checks.unique_together)
        target = ",".join(checks.unique_together)
        results.append(_result(_failing_rows(rows), name, "unique_combination", target))
    for column, values in checks.accepted.items():
        rows = unexpected_values(df, column, values)
        results.append(_result(_failing_rows(rows), name, "accepted_values", column))
    for column, (parent, parent_column) in checks.references.items():
        rows = orphan_keys(df, column, model(parent), parent_column)
        results.append(_result(_failing_records(rows), name, "relationships", column))
    for rule, condition in checks.holds.items():
        rows = broken_rules(df, {rule: condition})
        results.append(_result(_failing_rows(rows), name, "holds", rule))
    return results


def _model_results(
    name: str, checks: ModelChecks, model: Callable[[str], DataFrame]
) -> list[DataFrame]:
    """One pass where the model has one key that covers its other checks, else one per check."""
    key = one_pass_key(checks)
    if key:
        return [results_of(name, checks, key, value_counts(model(name), checks, key), model)]
    return _pass_per_check(name, checks, model)


def run_checks(
    models: dict[str, DataFrame], checks: dict[str, ModelChecks] | None = None
) -> DataFrame:
    """``(model, check_name, target, failures)``, one row per declared check.

    Run it on built tables, after all of them: a relationship may point at a
    model built later. It is one plan, so independent models run side by side; each
    declared model is scanned once.
    """
    results: list[DataFrame] = []
    for name, declared in (checks or CHECKS).items():
        results += _model_results(name, declared, models.__getitem__)
    return reduce(DataFrame.unionByName, results)


def enforce_checks(results: DataFrame) -> None:
    """Raise with every failing check of :func:`run_checks` (one row per declared check)."""
    failing = results.filter("failures > 0").orderBy("model", "check_name", "target").collect()
    if failing:
        lines = [f"{r.model}: {r.check_name}({r.target}) {r.failures}" for r in failing]
        raise ChecksFailed("; ".join(lines))


def quarantine(
    models: dict[str, DataFrame], checks: dict[str, ModelChecks], lake: Lake
) -> dict[str, DataFrame]:
    """Store the rows that break a rule, with the names of the broken ones in ``failed``, by model.

    A model without rules has no such table, one without broken rows an empty one.
    """
    found = {}
    for name, declared in checks.items():
        if declared.holds:
            rows = broken_rules(models[name], declared.holds)
            path = lake.path("quarantine", name)
            write_table(rows, path)
            found[name] = read_table(rows.sparkSession, path, rows.schema)
    return found
