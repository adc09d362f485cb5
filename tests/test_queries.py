"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

from tickloom.workload import QUERIES, fixtures

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_its_sql(spark, con, name):
    query = QUERIES[name]
    assert query.sql is not None
    assert difference(query.run(spark, SF_DIR), con, query.sql) is None


# Row counts stated in FIXTURES.md for the smallest scale.
ANCHORS = {
    "bars": 5_334,
    "directory": 10,
    "sector_lookup": 10,
    "metadata": 8,
    "stored_prices": 3_881,
    "incoming": 1_905,
    "dirty_prices": 5_334,
    "patchy_bars": 5_334,
    "trading_days": 1_670,
    "symbols": 8,
    "holidays": 9,
}


@pytest.mark.parametrize("name", ANCHORS)
def test_fixture_has_the_stated_size(spark, name):
    assert getattr(fixtures, name)(spark, "/root/testdata/sf0.001").count() == ANCHORS[name]
