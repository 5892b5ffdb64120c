"""Isotonic calibration against the max-min formula and a fit in one piece."""

import random

import numpy as np
import pytest

from gaugework.operators import isotonic


def brute(rows):
    """Highest over starts of the lowest mean over ends."""
    by = {}
    for s, y in rows:
        p, n = by.get(s, (0, 0))
        by[s] = p + y, n + 1
    scores = sorted(by)
    pos, n = np.cumsum([0, *[by[s][0] for s in scores]]), np.cumsum([0, *[by[s][1] for s in scores]])
    out = {}
    for i, s in enumerate(scores):
        out[s] = max(min((pos[k] - pos[j]) / (n[k] - n[j]) for k in range(i + 1, len(pos))) for j in range(i + 1))
    return out


def rising(draw, s):
    return int(draw.random() < 0.2 + 0.6 * s)


KINDS = {
    "rising": rising,
    "falling": lambda draw, s: int(draw.random() < 0.9 - 0.8 * s),
    "noise": lambda draw, s: draw.randrange(2),
    "ordered": lambda draw, s: int(s > 0.4),
    "waves": lambda draw, s: int(draw.random() < (s * 5) % 1),
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("size", [30, 1000])
def test_equals_max_min(spark, kind, size):
    draw = random.Random(kind)
    rows = [(s, KINDS[kind](draw, s)) for s in (draw.randrange(120) / 120 for _ in range(1500))]
    if kind == "rising":
        rows += [(1.0, 0)] * 700  # one hot score that pools what lies far below
    curve = isotonic.isotonic_curve(spark.createDataFrame(rows, "s double, y int"), "s", "y", size).collect()
    want = brute(rows)
    assert {r.score: pytest.approx(r.fitted, abs=1e-12) for r in curve} == want and len(curve) == len(want)
    assert sum(r.n for r in curve) == len(rows) and sum(r.pos for r in curve) == sum(y for _, y in rows)


def test_awkward_rows(spark):
    ddl = "s double, y int"
    assert isotonic.isotonic_curve(spark.createDataFrame([], ddl), "s", "y").count() == 0
    rows = [(None, 1), (0.5, None), (0.5, 1), (0.5, 0)]
    df = spark.createDataFrame(rows, ddl)
    assert [tuple(r) for r in isotonic.isotonic_curve(df, "s", "y").collect()] == [(0.5, 1, 2, 0.5)]
    got = isotonic.calibrated(df, "s", isotonic.isotonic_curve(df, "s", "y")).collect()
    assert sorted((r.s is None, r.calibrated) for r in got) == [(False, 0.5)] * 3 + [(True, None)]
