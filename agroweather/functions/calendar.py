"""Date expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default growing season, MM-DD, both ends included.
SEASON_START = "04-01"
SEASON_END = "10-31"


def _month_day_number(text: str) -> int:
    if not re.fullmatch(r"\d{2}-\d{2}", text):
        raise ValueError(f"expected MM-DD, got {text!r}")
    month, day = text.split("-")
    return int(month) * 100 + int(day)


def in_season(date: Column, start: str = SEASON_START, end: str = SEASON_END) -> Column:
    """Is the month-day of ``date`` within [start, end]?

    A window that wraps around the year end holds no date, because both bounds
    have to hold. Comparing month*100+day orders dates as zero-padded MM-DD text
    does, without building a string per row, and prunes partitions on ``date``.
    """
    month_day = F.month(date) * 100 + F.dayofmonth(date)
    return month_day.between(_month_day_number(start), _month_day_number(end))


def season_months(start: str = SEASON_START, end: str = SEASON_END) -> tuple[int, int]:
    """First and last month that may hold days of the season."""
    return _month_day_number(start) // 100, _month_day_number(end) // 100


def crop_year(date: Column) -> Column:
    return F.year(date).cast("bigint")


def iso_date(text: Column) -> Column:
    """Strict YYYY-MM-DD; anything else, also NULL, fails the job."""
    parsed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
    return F.coalesce(
        parsed,
        F.raise_error(F.concat(F.lit("not an ISO date: "), F.coalesce(text, F.lit("null")))).cast("date"),
    )
