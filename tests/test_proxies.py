"""The proxy views at sizes the driver's tables do not reach."""

import pytest
from pyspark.sql import functions as F

from agroweather.proxies.views import _fips


def test_county_keys_stay_distinct(spark):
    keys = spark.range(1, 1_000_001).select(_fips("id").alias("fips"))
    total = keys.agg(F.count_distinct("fips").alias("n"), F.max(F.length("fips")).alias("longest")).head()
    assert (total.n, total.longest) == (1_000_000, 5)


def test_a_state_too_wide_is_an_error(spark):
    assert spark.range(1_294_999, 1_295_000).select(_fips("id").alias("fips")).head().fips == "ZZ999"
    with pytest.raises(Exception, match="two characters"):
        spark.range(1_295_000, 1_295_001).select(_fips("id").alias("fips")).collect()
