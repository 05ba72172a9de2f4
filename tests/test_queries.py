"""Every registered query against its SQL, on the whole smallest tables."""

import pytest

import __spark_entry__ as entry_points
from rollcall.harness import load as own_queries
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
# Those of the text subpackage have tests of their own.
NAMES = list(own_queries().QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    verdict, _ = compare(spark, con, name, SF)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(NAMES) <= set(QUERIES) and set(own_queries().SQL) == set(NAMES)
    assert set(entry_points.oracle_sql()) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "Nr" and df.count() > 0
