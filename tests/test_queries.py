"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from registry.oracle import ORACLE
from registry.queries import QUERIES
from compare import connect, duckdb_result, spark_result

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(NAMES)
    assert set(NAMES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, small, db):
    got = spark_result(entry.queries()[name](spark, small))
    assert got == duckdb_result(db, entry.oracle_sql()[name])


def test_entry(spark, small):
    assert entry.entry(spark).columns == ["split", "tier", "n_conversations", "n_messages"]
