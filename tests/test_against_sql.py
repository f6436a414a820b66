"""Queries against their SQL on the smallest tables; ``checks/compare.py`` runs all of them."""

import pytest

from checks.compare import compare, duckdb_views
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
SLOW = {"daily_features_refreshed", "daily_features_streamed", "scan_items"}


@pytest.fixture(scope="module")
def views():
    return duckdb_views(SF)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_equals_sql(spark, views, name):
    outcome, _ = compare(spark, views, QUERIES[name], ORACLE[name], SF)
    assert outcome == "ok"


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry_point

    found = entry_point.entry(spark)
    assert found.count() == 150 and set(entry_point.oracle_sql()) <= set(entry_point.queries())
