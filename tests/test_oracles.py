"""Every registered query runs on the small tables; those with SQL must equal it."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_one_row_per_policy(spark):
    assert entry.entry(spark).count() == 4


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, con, small):
    problem, _ = difference(spark, QUERIES[name], ORACLES[name], con, small)
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark, small):
    df = QUERIES[name](spark, small)
    assert df.columns and len(df.collect()) > 0
