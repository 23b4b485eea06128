"""County identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes that stand for a state total, a district remainder, or nothing.
NON_COUNTY_CODES = ["000", "998", ""]


def county_fips(state_code: Column, county_code: Column) -> Column:
    """Five-character county key; NULL when either part is NULL."""
    return F.concat(F.lpad(state_code, 2, "0"), F.lpad(county_code, 3, "0"))


def is_county_code(county_code: Column) -> Column:
    """TRUE for a real county; NULL (so filtered out) for a NULL code."""
    return ~county_code.isin(NON_COUNTY_CODES)
