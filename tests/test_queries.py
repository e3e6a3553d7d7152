"""Every registered query against its SQL in DuckDB on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare
from lakeload.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert compare(spark, name, SF).startswith("ok")


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "status" in df.columns
