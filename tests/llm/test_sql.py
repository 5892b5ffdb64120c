"""Queries that SQL can express, on whole tables."""

import compare
import pytest

from gaugework.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLES[name]) == []
