"""Registered queries against their SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["zone_id", "pickup_hour", "trips_count"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    assert compare.compare(spark, con, entry.queries()[name], entry.oracle_sql().get(name), SF) == ""
