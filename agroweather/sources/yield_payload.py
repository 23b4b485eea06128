"""Landed yield responses to raw yield records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroweather.schemas import YIELD_TEXT_FIELDS

# The scope of a yield request.
YIELD_STATISTIC = "YIELD"
AGGREGATION_LEVELS = ["COUNTY", "STATE"]


def _text(record: Column, field: str) -> Column:
    """Field text; a missing key gives "", an explicit null stays NULL."""
    return F.when(F.map_contains_key(record, field), record[field]).otherwise(F.lit(""))


def _year(record: Column) -> Column:
    """Whole number; empty, null or missing gives NULL, other text fails the job."""
    text = F.nullif(record["year"], F.lit(""))
    number = text.try_cast("bigint")
    return F.when(
        text.isNotNull(),
        F.coalesce(
            number,
            F.raise_error(F.concat(F.lit("year is not a whole number: "), text)).cast("bigint"),
        ),
    )


def parse_yield_payloads(payloads: DataFrame) -> DataFrame:
    """``(body)`` to raw yield columns without the load stamp.

    A response without ``data`` holds no records. Fields outside the contract
    are dropped, ``Value`` becomes ``value_raw`` as reported.
    """
    records = payloads.select(
        F.explode(
            F.from_json(
                "body", "struct<data: array<map<string, string>>>", {"mode": "FAILFAST"}
            )["data"]
        ).alias("record")
    )
    record = F.col("record")
    return records.select(
        *[_text(record, field).alias(field) for field in YIELD_TEXT_FIELDS],
        _year(record).alias("year"),
        _text(record, "Value").alias("value_raw"),
    )


def in_scope(
    records: DataFrame, *, commodities: list[str], states: list[str], year: int
) -> DataFrame:
    """Records of one run: commodity, state, year, yield statistic, county or state level.

    A record that does not carry its level was selected by the request itself.
    """
    return records.filter(
        F.col("commodity_desc").isin(commodities)
        & F.col("state_alpha").isin(states)
        & (F.col("year") == F.lit(int(year)))
        & (F.col("statisticcat_desc") == F.lit(YIELD_STATISTIC))
        & F.col("agg_level_desc").isin([*AGGREGATION_LEVELS, ""])
    )
