"""Every registered query against its SQL in DuckDB."""

import os

import pytest
from compare import connect, difference
from compare import SF_DIR

import __spark_entry__ as entry_point
from larkmetric.plans.checks import CHECKS
from larkmetric.plans.queries import QUERIES

SF = os.environ.get("CHECK_SF_DIR", SF_DIR)


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(CHECKS) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_check(spark, duck, name):
    df = entry_point.queries()[name](spark, SF)
    assert difference(df, duck, entry_point.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["media_source", "mau", "dau"]


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_check_compares_rows(duck, name):
    assert duck.sql(f"SELECT count(*) FROM ({CHECKS[name]}) q").fetchall()[0][0] > 0
