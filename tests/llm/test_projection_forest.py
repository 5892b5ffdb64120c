"""The projection forest against exact search."""

import numpy as np
import pytest

from gaugework.llm.common import QUERIES
from gaugework.llm.projection_forest import Forest, best, fitted, nearest

DDL = "vec_id long, embedding array<float>"


def exact(ids, x, k=20, every=20):
    """{query id: [(id, score)]} by brute force."""
    ids, x = np.asarray(ids), np.asarray(x, dtype=np.float64)
    out = {}
    for i in np.nonzero(ids % every == 0)[0]:
        score = x @ x[i]
        score[i] = -np.inf
        near = np.lexsort((ids, -score))[:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in near if j != i]
    return out


def checked(rows, got, want, k=20):
    """Shape, order and scores of a result; returns its recall."""
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert by.keys() == want.keys()
    hits = total = 0
    for q, near in want.items():
        own = sorted(by[q], key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(near) + 1))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert len({r.vec_id for r in own}) == len(own) and q not in {r.vec_id for r in own}
        for r in own:
            assert r.score == pytest.approx(float(np.dot(rows[q], rows[r.vec_id])), rel=1e-9, abs=1e-12)
        hits += len({r.vec_id for r in own} & {v for v, _ in near})
        total += len(near)
    return hits / total


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_recall(spark, folder):
    rows = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    got = QUERIES["op12_projection_forest"](spark, folder).collect()
    assert checked(rows, got, exact(list(rows), list(rows.values()))) >= 0.93


def cone(draw, n, d, mean):
    """Unit vectors with that mean cosine among them."""
    axis, x = np.zeros(d), draw.normal(size=(n, d))
    axis[0] = 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.sqrt(mean) * axis + np.sqrt(1 - mean) * x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def shapes():
    draw = np.random.default_rng(3)
    clusters = draw.normal(size=(60, 48))[draw.integers(0, 60, 6000)] + 0.2 * draw.normal(size=(6000, 48))
    hot = draw.normal(size=(6000, 32))
    hot[: 2000] = hot[0] + 0.05 * draw.normal(size=(2000, 32))
    lengths = draw.normal(size=(6000, 24)) * draw.lognormal(0, 1, size=(6000, 1))
    lengths[17] *= 1000
    return {"cone": cone(draw, 6000, 64, 0.8), "clusters": clusters, "hot": draw.permutation(hot), "lengths": lengths}


@pytest.mark.parametrize("shape", ["cone", "clusters", "hot", "lengths"])
def test_recall_of_shapes(spark, shape):
    x = shapes()[shape].astype(np.float32)
    rows = {i: v.astype(np.float64) for i, v in enumerate(x)}
    got = nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], DDL), leaf=128, block=100).collect()
    assert checked(rows, got, exact(list(rows), list(rows.values()))) >= 0.9


def test_clusters_need_few_leaves():
    """Unit vectors in clusters: a tenth of the leaves holds nearly all neighbours."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(64, 32))[draw.integers(0, 64, 20_000)] + 0.05 * draw.normal(size=(20_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = fitted(x, len(x), 1.0, leaf=512)
    leaves, at, hits = forest.leaf_of(forest.stored_coordinates(x)), forest.query_coordinates(x[:50]), 0
    assert forest.leaves == 64 and np.bincount(leaves.ravel()).max() < 1200
    for i in range(50):
        order = list(forest.walk(at[i]))
        assert len(order) == len(set(order)) == 4 * 64
        near = np.argsort(-(x @ x[i]))[:20]
        hits += int(np.isin(leaves[near], order[:25]).any(axis=1).sum())
    assert hits >= 0.97 * 50 * 20


def test_ties_beyond_all_blocks():
    q, v = np.ones((3, 4)), np.ones((70_000, 4))
    i, j, score = best(q, v, np.arange(70_000)[::-1].copy(), np.zeros(70_000), 5)
    assert i.tolist() == [0] * 5 + [1] * 5 + [2] * 5 and j.tolist() == [69_999 - x for x in range(5)] * 3 and set(score) == {4.0}


def test_walk_takes_cells_by_distance():
    forest = Forest(1, np.zeros((2, 1, 3)), [[np.array([0.0])], [np.array([1.0])]], 1.0, 1.0)
    assert list(forest.walk(np.array([[0.5], [0.9]]))) == [1, 2, 3, 0]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [2.0, 1.0]), (3, [2.0, 1.0]), (None, [2.0, 1.0]), (4, [-1.0, 5.0]), (4, [-1.0, 5.0]), (20, [0.0, 1.0]),
        (5, None), (40, None), (6, [0.0, 0.0]), (60, [0.0, 0.0]), (7, [1.0, None]), (8, [1.0, nan]), (80, [inf, 1.0]), (9, []), (100, [1.0, 2.0, 3.0]),
    ]
    frame = spark.createDataFrame([(*r, "x", 1.0, 0, 1) for r in rows], f"{DDL}, node string, score double, size int, rank int")
    got = sorted(nearest(frame).collect())
    by = {q: [(r.vec_id, r.score) for r in got if r.query_id == q] for q in {r.query_id for r in got}}
    assert by == {0: [(1, 2.0), (2, 2.0), (3, 2.0), (None, 2.0), (20, 0.0), (4, -1.0)], 20: [(4, 5.0), (1, 1.0), (2, 1.0), (3, 1.0), (None, 1.0), (0, 0.0)]}
    assert [r.rank for r in got] == [1, 2, 3, 4, 5, 6] * 2
    for few in (frame.limit(0), frame.where("vec_id = 1"), frame.where("vec_id = 0"), frame.where("vec_id = 100 or vec_id = 0")):
        assert nearest(few).collect() == []


def test_many_copies_keep_the_smallest_ids(spark):
    rows = [(i, [1.0, 2.0]) for i in range(3000)] + [(5000 + i, [float(i % 7), 1.0]) for i in range(200)]
    got = nearest(spark.createDataFrame(rows, DDL), leaf=16, block=16).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = exact([i for i, _ in rows], [v for _, v in rows])
    assert by == want
