"""Keep the latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], latest: str) -> DataFrame:
    """One row per key: the one with the greatest ``latest``, NULLs last.

    All other columns break ties, highest first, so that re-runs pick the same
    row. Spark limits each map task to one row per key before the shuffle
    (WindowGroupLimit), so a key with very many copies does not reach one task,
    and filters on the keys move below the window to the scan.
    """
    tiebreak = [name for name in df.columns if name not in (*keys, latest)]
    newest_first = Window.partitionBy(*keys).orderBy(
        *[F.col(name).desc_nulls_last() for name in (latest, *tiebreak)]
    )
    return (
        df.withColumn("_row_number", F.row_number().over(newest_first))
        .filter(F.col("_row_number") == 1)
        .drop("_row_number")
    )
