"""Pointer doubling over long chains, forests and cycles."""

import pytest

from gaugework.operators import joins

DDL = "i int, p int"


def test_all_ancestors_of_a_chain(spark):
    tree = spark.createDataFrame([(i, i - 1 if i else None) for i in range(150)] + [(1000, 70)], DDL)
    want = {(i, j, i - j) for i in range(150) for j in range(i)} | {(1000, j, 71 - j) for j in range(71)}
    got = [tuple(r) for r in joins.ancestors(tree, "i", "p").collect()]
    assert len(got) == len(want) and set(got) == want
    with pytest.raises(ValueError, match="deeper"):
        joins.ancestors(tree, "i", "p", 100)


def test_a_chain_of_5000_takes_13_rounds(spark, monkeypatch):
    rounds, cut = [], joins.cut
    monkeypatch.setattr(joins, "cut", lambda df: rounds.append(1) or cut(df))
    tree = spark.createDataFrame([(i, i - 1 if i else None) for i in range(5000)], DDL)
    got = {r.node: (r.root, r.depth) for r in joins.roots(tree, "i", "p").collect()}
    assert got == {i: (0, i) for i in range(5000)}
    assert len(rounds) - 2 <= 13  # the first table and the last round, which moves nothing


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_cycles_of_any_length(spark, size):
    ring = [(i, (i + 1) % size) for i in range(size)] + [(100, 0), (200, None), (201, 200)]
    tree = spark.createDataFrame(ring, DDL)
    for find in (joins.ancestors, joins.roots):
        with pytest.raises(ValueError):
            find(tree, "i", "p")


def test_forests_and_parents_without_a_row(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 99), (4, 3)], DDL)
    assert sorted(map(tuple, joins.roots(tree, "i", "p").collect())) == [(1, 1, 0), (2, 1, 1), (3, 99, 1), (4, 99, 2)]
    assert joins.ancestors(tree.limit(0), "i", "p").collect() == [] and joins.roots(tree.limit(0), "i", "p").collect() == []
