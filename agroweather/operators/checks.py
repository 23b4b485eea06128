"""Data-quality operators. Each returns failing rows; no rows means the check passes."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, failures)`` for every column, all counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    rows = [F.struct(F.lit(name).alias("column_name"), F.col(name).alias("failures")) for name in columns]
    return counts.select(F.inline(F.array(*rows)))


def duplicate_keys(df: DataFrame, keys: list[str], *, ignore_nulls: bool = False) -> DataFrame:
    """``(keys, n_records)`` of keys held more than once.

    NULL keys group together and count, unless ``ignore_nulls``. Counting is
    combined before the shuffle, so a key with very many copies stays cheap.
    """
    if ignore_nulls:
        df = df.dropna(subset=keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def unexpected_values(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """``(column, n_records)`` of values outside the list; NULL passes."""
    return (
        df.filter(~F.col(column).isin(accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def orphan_keys(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None
) -> DataFrame:
    """``(column, n_records)`` of child keys without a parent; NULL passes.

    The child is counted per key before the join: what reaches the join is one
    row per distinct key, however often a key occurs.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = parent.select(F.col(parent_column or column).alias(column))
    return keys.join(parents, column, "left_anti")


def out_of_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows outside [low, high]; NULL passes, NaN fails any upper bound."""
    bounds = []
    if low is not None:
        bounds.append(F.col(column) < F.lit(low))
    if high is not None:
        bounds.append(F.col(column) > F.lit(high))
    return df.filter(reduce(lambda a, b: a | b, bounds))


def broken_rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows for which a condition is false, with the names of those conditions in ``failed``.

    Conditions are SQL; one that is NULL for a row passes. One scan for all rules.
    """
    names = [F.when(~F.expr(rule), F.lit(name)) for name, rule in rules.items()]
    broken = reduce(lambda a, b: a | b, [~F.expr(rule) for rule in rules.values()])
    return df.where(F.coalesce(broken, F.lit(False))).withColumn("failed", F.array_compact(F.array(*names)))


def freshness(df: DataFrame, stamp: str, now: datetime, max_age: timedelta) -> DataFrame:
    """One row ``(latest, age_seconds, stale)`` against a given instant; empty is stale."""
    age = F.unix_timestamp(F.lit(now)) - F.unix_timestamp("latest")
    return (
        df.agg(F.max(stamp).alias("latest"))
        .withColumn("age_seconds", age)
        .withColumn(
            "stale",
            F.coalesce(F.col("age_seconds") > int(max_age.total_seconds()), F.lit(True)),
        )
    )


def reconcile(layers: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """``(layer, n_rows, n_keys)`` per layer of the same data.

    Rows are first counted per key, which combines copies before the shuffle.
    """

    def totals(name: str, df: DataFrame) -> DataFrame:
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        return per_key.agg(
            F.lit(name).alias("layer"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
        )

    return reduce(DataFrame.unionByName, [totals(name, df) for name, df in layers.items()])


def content_digest(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """``(by, n_rows, hash_sum, hash_xor)``: each group's rows as a bag, whatever their order.

    Partial sums are combined before the shuffle: one row per group and task.
    """

    def hashed(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), *columns)

    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(hashed(0).cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor(hashed(1)).alias("hash_xor"),
    )


def differing_groups(
    left: DataFrame, right: DataFrame, by: list[str], columns: list[str]
) -> DataFrame:
    """``(by, left_rows, right_rows)`` of the groups whose rows differ between two layers.

    A group is compared by its number of rows and two digests of their content, so one
    changed value is found though all counts agree. NULL is a group of its own; a
    group that a layer lacks has no rows there.
    """
    sides = [
        content_digest(df, by, columns).select(
            *[F.col(name).alias(f"{side}_{name}") for name in by],
            F.col("n_rows").alias(f"{side}_rows"),
            F.struct("n_rows", "hash_sum", "hash_xor").alias(f"{side}_digest"),
        )
        for side, df in (("left", left), ("right", right))
    ]
    same = reduce(lambda a, b: a & b, [F.col(f"left_{n}").eqNullSafe(F.col(f"right_{n}")) for n in by])
    return (
        sides[0]
        .join(sides[1], same, "full_outer")
        .where(~F.col("left_digest").eqNullSafe(F.col("right_digest")))
        .select(
            *[F.coalesce(f"left_{name}", f"right_{name}").alias(name) for name in by],
            F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
            F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
        )
    )
