"""The registered queries against their DuckDB statements at the smallest scale."""

import os

import pytest

import compare_oracle
from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("AGROWEATHER_SF_DIR", "/root/testdata/sf0.001")


pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return compare_oracle.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert {name for name in queries() if name.startswith("q_")} <= oracle_sql().keys()


def test_entry(spark):
    assert entry(spark).count() == 146


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, name):
    found = compare_oracle.compare(spark, con, SF_DIR, name)
    assert found.rows > 0
    assert found.same, (found.only_spark.most_common(3), found.only_oracle.most_common(3))
    assert not any("HUGEINT" in kind or "DECIMAL" in kind for kind in found.oracle_types)
