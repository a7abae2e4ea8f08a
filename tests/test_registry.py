"""Every registered query against its oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as registry
from check import TABLES, compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


@pytest.fixture(scope="module")
def db():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


NAMES = sorted(name for area in registry.AREAS for name in area.Q)


def test_every_query_has_an_oracle_or_a_brute_force_test():
    assert set(NAMES) <= set(registry.queries())
    assert set(NAMES) - set(registry.oracle_sql()) == registry.quality.BRUTE_FORCE


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    outcome = compare(spark, db, name, registry.queries()[name], registry.oracle_sql().get(name), SF)
    assert not outcome.startswith("FAIL"), outcome


def test_entry(spark):
    assert registry.entry(spark).count() > 0
