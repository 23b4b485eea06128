"""Record-count gate of the yield source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a request that would return this many records or more is refused.
RECORD_LIMIT = 50_000

CELL = ["commodity_desc", "state_alpha", "year"]


class RecordLimitExceeded(RuntimeError):
    """A commodity, state and year holds too many records to be loaded."""


def work_list(states: DataFrame, commodities: list[str], years: list[int]) -> DataFrame:
    """Every (commodity, state, year) of a run: each ``state_alpha`` times the two lists."""

    def each(values: list, kind: str) -> Column:
        return F.explode(F.lit(values).cast(f"array<{kind}>"))

    return states.select("state_alpha", each(commodities, "string").alias("commodity_desc")).select(
        "commodity_desc", "state_alpha", each(years, "bigint").alias("year")
    )


def record_counts(
    records: DataFrame, work: DataFrame | None = None, limit: int = RECORD_LIMIT
) -> DataFrame:
    """Records per cell and whether the cell reaches the limit.

    With a work list the cells are those of the list, empty ones included.
    """
    counts = records.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n_records"))
    if work is not None:
        counts = work.join(counts, CELL, "left").fillna(0, ["n_records"])
    return counts.select(*CELL, "n_records", (F.col("n_records") >= limit).alias("over_limit"))


def enforce_record_limit(counts: DataFrame) -> None:
    """Raise when any cell is over the limit, before anything is written."""
    over = counts.filter("over_limit").orderBy(F.desc("n_records")).head(1)
    if over:
        cell = over[0]
        raise RecordLimitExceeded(
            f"{cell.n_records} records for "
            f"{cell.commodity_desc}/{cell.state_alpha}/{cell.year} reach the limit"
        )
