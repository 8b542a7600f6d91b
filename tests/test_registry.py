"""Every query with an SQL twin, against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from check import connect, difference

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(BASE)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    found = registry.queries()[name](spark, BASE).toPandas()
    assert len(found) > 0
    assert difference(found, duck.sql(registry.oracle_sql()[name]).df()) is None


def test_twins_belong_to_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_runs(spark):
    assert registry.entry(spark).limit(1).count() == 1
