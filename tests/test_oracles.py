"""Every registered query against its reference SQL on the smallest tables."""

import pytest

import compare
from gaugework.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small, con, name):
    assert compare.differences(QUERIES[name](spark, small), con, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, small, name):
    rows = QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    assert rows


def test_entry_has_a_stable_schema(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert df.schema == entry.entry(spark).schema
    assert set(entry.oracle_sql()) <= set(entry.queries())
