"""Yield text and unit expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tonnes per hectare for one bushel per acre, by commodity.
T_HA_PER_BU_ACRE = {
    "corn": 0.0627677,
    "soybeans": 0.0672511,
}

# Numbers as the reporting format writes them: sign, decimals, exponent, blanks
# around, infinity and nan words. Spark's own cast would also take 1.5d and 0x1p3.
NUMBER_TEXT = (
    r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$"
    r"|^\s*([+-]?inf(inity)?|nan)\s*$"
)


def parse_yield(value_raw: Column) -> Column:
    """Number behind a reported value; suppression flags and other text give NULL."""
    digits = F.replace(value_raw, F.lit(","), F.lit(""))
    return F.when(digits.rlike(NUMBER_TEXT), digits.try_cast("double"))


def bu_acre_to_t_ha(yield_value: Column, commodity: Column) -> Column:
    """Bushels per acre to tonnes per hectare; NULL for a commodity without a factor."""
    name = F.lower(commodity)
    return reduce(
        lambda chain, item: chain.when(name == item[0], yield_value * F.lit(item[1])),
        T_HA_PER_BU_ACRE.items(),
        F,
    )
