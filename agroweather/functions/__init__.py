from agroweather.functions.calendar import crop_year, in_season, iso_date
from agroweather.functions.counties import county_fips, is_county_code
from agroweather.functions.weather import (
    growing_degrees,
    is_dry_day,
    is_heat_stress_day,
)
from agroweather.functions.yields import bu_acre_to_t_ha, parse_yield

__all__ = [
    "bu_acre_to_t_ha",
    "county_fips",
    "crop_year",
    "growing_degrees",
    "in_season",
    "is_county_code",
    "is_dry_day",
    "is_heat_stress_day",
    "iso_date",
    "parse_yield",
]
