"""Pivot-permutation index against brute force over all pairs."""

import math

import numpy as np
import pytest

from gaugework.llm import pivot_index
from gaugework.llm.common import QUERIES

DDL = "vec_id long, embedding array<float>, node string"


def brute(rows, threshold=0.95):
    """(links, component) by row position; None embeddings and such link with nothing."""
    good = [i for i, v in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for size in {len(rows[i]) for i in good}:
        own = [i for i in good if len(rows[i]) == size]
        x = np.array([rows[i] for i in own], dtype=np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        p, q = np.nonzero(np.triu(x @ x.T >= threshold, 1))
        for a, b in zip(p, q, strict=True):
            a, b = own[a], own[b]
            links[a] += 1
            links[b] += 1
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    return links, [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_has_all_links(spark, folder):
    rows = sorted(((r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()))
    links, root = brute([v for _, v in rows])
    got = sorted(QUERIES["op3_pivot_permutation"](spark, folder).collect())
    assert [r.vec_id for r in got] == [i for i, _ in rows]
    assert sum(r.n_links for r in got) >= 0.99 * sum(links)
    assert np.mean([r.component_id == rows[root[k]][0] for k, r in enumerate(got)]) > 0.995
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def vectors():
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 16))
    rows = [centres[i % 40] + draw.normal(size=16) * 0.05 for i in range(300)]
    rows += [centres[0] + draw.normal(size=16) * 0.02 for _ in range(200)]
    return [[float(np.float32(x)) for x in v] for v in rows] + [[1.0] * 16] * 30


@pytest.mark.parametrize("block", [16, 1024])
def test_hot_lists_are_cut_into_blocks(spark, block):
    rows = vectors()
    links, root = brute(rows)
    _, nodes = pivot_index._distinct(spark.createDataFrame([(i, v, None) for i, v in enumerate(rows)], DDL))
    pivots = pivot_index.choose_pivots(nodes, 500, per_root=1)
    found = pivot_index.found_links(pivot_index.described(nodes, pivots), shared=1, block=block)
    total = found.groupBy().sum("links").first()[0] + 0
    copies = sum(links[-30:])  # the last rows are one node and link among themselves only
    assert total >= 0.98 * (sum(links) - copies) and total <= sum(links) - copies


def test_dense_group_of_different_vectors(spark):
    draw = np.random.default_rng(5)
    centre = draw.normal(size=64)
    for spread in (0.15, 0.27):  # pair cosines around 0.98, and on both sides of the threshold
        rows = [[float(np.float32(x)) for x in v] for v in [*(centre + spread * draw.normal(size=(1000, 64))), *draw.normal(size=(2000, 64))]]
        links, root = brute(rows)
        got = sorted(pivot_index.near_vectors(spark.createDataFrame([(i, v, None) for i, v in enumerate(rows)], DDL)).collect())
        assert 0.99 * sum(links) <= sum(r.n_links for r in got) <= sum(links)
        assert np.mean([r.component_id == root[i] for i, r in enumerate(got)]) > 0.995


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [None, [], [0.0, 0.0], [1.0, nan], [1.0, inf], [1.0, None], [1.0, 2.0], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 3.0], [-1.0, -2.0], [-0.0, 1.0], [0.0, 1.0]]
    docs = spark.createDataFrame([(i, v, "clash") for i, v in enumerate(rows)] + [(None, [1.0, 2.0], None)], DDL)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pivot_index.near_vectors(docs).collect()}
    assert got[6] == (3, 6, True) and got[7] == (3, 6, False) and got[8] == (3, 6, False) and got[None] == (3, 6, False)
    assert got[11] == (1, 11, True) and got[12] == (1, 11, False)
    for i in (0, 1, 2, 3, 4, 5, 9, 10):
        assert got[i] == (0, i, True)
    assert pivot_index.near_vectors(docs.limit(0)).count() == 0
