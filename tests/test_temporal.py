"""Point-in-time operators: boundaries, ties, nulls, hot keys, and independence of the cell width."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from gaugework.operators.latest import latest_conflicts, latest_per_key, require_no_conflict
from gaugework.operators.temporal import (
    as_of_latest,
    clip,
    count_in_window,
    covering_at,
    first_after,
    interval_issues,
    stab,
    time_to_next,
    with_neighbours,
)

T = datetime(2024, 3, 1)
H = timedelta(hours=1)
US = timedelta(microseconds=1)
LEFT = "id int, k int, t timestamp"
RIGHT = "k int, u timestamp, v int"


def left(spark, *times, k=1):
    return spark.createDataFrame([(i, k, t) for i, t in enumerate(times)], LEFT)


def right(spark, *rows, k=1):
    return spark.createDataFrame([(k, t, v) for t, v in rows], RIGHT)


def column(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def test_as_of_takes_an_equal_instant_unless_strict(spark):
    l, r = left(spark, T - US, T, T + US), right(spark, (T, 5))
    assert column(as_of_latest(l, r, "k", "t", "u", ["v"]), "v") == [None, 5, 5]
    assert column(as_of_latest(l, r, "k", "t", "u", ["v"], strict=True), "v") == [None, None, 5]


def test_as_of_ties_take_the_highest_tie_column(spark):
    r = right(spark, (T, 5), (T, 9), (T, 7))
    assert column(as_of_latest(left(spark, T + H), r, "k", "t", "u", ["v"], tie=["v"]), "v") == [9]


def test_as_of_keeps_every_left_row_and_null_keys(spark):
    l = spark.createDataFrame([(0, 1, T), (1, 1, T), (2, None, T), (3, 2, None)], LEFT)
    out = as_of_latest(l, right(spark, (T - H, 4)), "k", "t", "u", ["v"])
    assert column(out, "v") == [4, 4, None, None]


def test_as_of_reports_the_time_found_across_distant_cells(spark):
    r = right(spark, (T - 400 * timedelta(days=1), 3))
    out = as_of_latest(left(spark, T), r, "k", "t", "u", ["v"], matched="at", cell="1 hour")
    assert column(out, "at") == [T - 400 * timedelta(days=1)]


def test_window_count_is_closed_at_the_start_and_open_at_the_end(spark):
    day = timedelta(days=90)
    r = right(spark, (T - day - US, 0), (T - day, 0), (T - H, 0), (T, 0))
    assert column(count_in_window(left(spark, T), r, "k", "t", "u", "90 days"), "events_in_window") == [2]
    assert column(count_in_window(left(spark, T), r, "k", "t", "u", "90 days", closed="(]"), "events_in_window") == [2]
    assert column(count_in_window(left(spark, T - 2 * day), r, "k", "t", "u", "90 days"), "events_in_window") == [0]


def test_window_count_when_one_probe_ends_where_another_begins(spark):
    r = right(spark, (T, 0), (T + H, 0), (T + 2 * H, 0))
    out = count_in_window(left(spark, T, T + H, T + 2 * H, T + 3 * H), r, "k", "t", "u", "1 hour")
    assert column(out, "events_in_window") == [0, 1, 1, 1]


def test_first_after_is_open_at_the_start_and_closed_at_the_horizon(spark):
    horizon = timedelta(hours=168)
    assert column(first_after(left(spark, T), right(spark, (T, 0), (T + horizon, 0)), "k", "t", "u", "168 hours"), "next_time") == [T + horizon]
    assert column(first_after(left(spark, T), right(spark, (T + horizon + US, 0)), "k", "t", "u", "168 hours"), "next_time") == [None]
    assert column(time_to_next(left(spark, T), right(spark, (T, 0)), "k", "t", "u", "1 hour"), "seconds_to_next") == [0.0]


def intervals(spark, *rows):
    return spark.createDataFrame([(1, i, a, b, s) for i, (a, b, s) in enumerate(rows)], "k int, sid int, a timestamp, b timestamp, s string")


def test_stab_at_touching_open_and_missing_intervals(spark):
    iv = intervals(spark, (T, T + H, "one"), (T + H, None, "two"))
    out = stab(left(spark, T - US, T, T + H, T + 50 * H), iv, "k", "t", "a", "b", {"s": "s"}, ["sid"], {"s": "Unknown"}, "n")
    assert column(out, "s") == ["Unknown", "one", "two", "two"]
    assert column(out, "n") == [0, 1, 1, 1]


def test_stab_shows_overlaps_and_ignores_empty_intervals(spark):
    iv = intervals(spark, (T, T + 10 * H, "long"), (T + H, T + 2 * H, "short"), (T + 5 * H, T + 5 * H, "empty"))
    out = stab(left(spark, T + H, T + 5 * H), iv, "k", "t", "a", "b", {"s": "s"}, ["sid"], covering="n")
    assert column(out, "s") == ["long", "long"]
    assert column(out, "n") == [2, 1]
    fixed = covering_at(iv, ["k"], "a", "b", F.lit(T + H), {"s": "s"}, ["sid"]).collect()
    assert [(r["s"], r["covering"]) for r in fixed] == [("long", 2)]


def test_clip_drops_what_lies_outside(spark):
    iv = intervals(spark, (T - H, T + H, "in"), (T + 3 * H, None, "open"), (T - 5 * H, T, "before"), (T + 9 * H, T + 10 * H, "after"))
    out = {r["s"]: r["hours"] for r in clip(iv, "a", "b", F.lit(T), F.lit(T + 4 * H)).collect()}
    assert out == {"in": 1.0, "open": 1.0}


def test_interval_issues_name_overlap_gap_and_invalid(spark):
    iv = intervals(spark, (T, T + 4 * H, "a"), (T + H, T + 2 * H, "b"), (T + 6 * H, None, "c"), (T + 7 * H, T + 7 * H, "d"))
    got = sorted((r["kind"], r["issue_start"], r["issue_end"]) for r in interval_issues(iv, ["k"], "a", "b", "sid").collect())
    assert got == [("gap", T + 4 * H, T + 6 * H), ("invalid", T + 7 * H, T + 7 * H), ("overlap", T + H, T + 2 * H)]


def test_neighbours_across_cells_with_null_key(spark):
    df = spark.createDataFrame([(1, T, 1), (1, T + 100 * H, 2), (None, T, 3), (None, T + H, 4)], "k int, t timestamp, i int")
    out = with_neighbours(df, ["k"], "t", ["i"], {"p": "i"}, {"n": "i"}, cell="1 hour")
    assert {r["i"]: (r["p"], r["n"]) for r in out.collect()} == {1: (None, 2), 2: (1, None), 3: (None, 4), 4: (3, None)}


def test_a_burst_of_one_key_is_spread_over_tasks(spark):
    """A third of all rows on one key in one hour: the busiest slot holds few of them, and the results stay."""
    from gaugework.functions.when import micros, span
    from gaugework.operators.scan import FAN, slot_of

    burst = [(0, T + timedelta(milliseconds=1800 * i), i) for i in range(2000)]
    others = [(1 + i % 40, T + timedelta(minutes=11 * i), 2000 + i) for i in range(4000)]
    df = spark.createDataFrame(burst + others, "k int, t timestamp, i int")
    top = df.groupBy("k", slot_of(micros("t"), span("1 day"))).count().agg(F.max("count")).first()[0]
    assert top <= 2 * len(burst) / (3600 / (86_400 / FAN)) and top < 0.02 * df.count()
    out = {r["i"]: (r["p"], r["n"]) for r in with_neighbours(df, ["k"], "t", ["i"], {"p": "i"}, {"n": "i"}).where("k = 0").collect()}
    assert out == {i: (i - 1 if i else None, i + 1 if i < 1999 else None) for i in range(2000)}
    probes = spark.createDataFrame([(i, 0, T + timedelta(minutes=i)) for i in range(61)], LEFT)
    counts = column(count_in_window(probes, df.select("k", F.col("t").alias("u"), F.col("i").alias("v")), "k", "t", "u", "10 minutes"), "events_in_window")
    want = [sum(T + timedelta(minutes=m - 10) <= u < T + timedelta(minutes=m) for _, u, _ in burst) for m in range(61)]
    assert counts == want


def test_latest_row_and_conflicts(spark):
    df = spark.createDataFrame([(1, T, "a"), (1, T, "a"), (2, T, "x"), (2, T, "y"), (2, T - H, "z"), (3, None, "n")], "k int, t timestamp, s string")
    assert {(r["k"], r["s"]) for r in latest_per_key(df, ["k"], ["t"]).collect()} == {(1, "a"), (2, "y"), (3, "n")}
    assert [r["k"] for r in latest_conflicts(df, ["k"], "t", ["s"]).collect()] == [2]
    with pytest.raises(ValueError, match="conflicting"):
        require_no_conflict(df, ["k"], "t", ["s"])


moments = st.integers(0, 60).map(lambda m: T + timedelta(minutes=7 * m))
rows = st.lists(st.tuples(st.integers(1, 3), moments, st.integers(0, 9)), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(lefts=rows, rights=rows, cell=st.sampled_from(["10 minutes", "1 hour", "30 days"]))
def test_operators_agree_with_brute_force(spark, lefts, rights, cell):
    l = spark.createDataFrame([(i, k, t) for i, (k, t, _) in enumerate(lefts)], LEFT)
    r = spark.createDataFrame(rights, RIGHT)
    span = timedelta(hours=2)
    want_v, want_n, want_next = [], [], []
    for k, t, _ in lefts:
        mine = [(u, v) for kk, u, v in rights if kk == k]
        past = [(u, v) for u, v in mine if u <= t]
        want_v.append(max(past)[1] if past else None)
        want_n.append(sum(t - span <= u < t for u, _ in mine))
        want_next.append(min((u for u, _ in mine if t < u <= t + span), default=None))
    assert column(as_of_latest(l, r, "k", "t", "u", ["v"], tie=["v"], cell=cell), "v") == want_v
    assert column(count_in_window(l, r, "k", "t", "u", "2 hours", cell=cell), "events_in_window") == want_n
    assert column(first_after(l, r, "k", "t", "u", "2 hours", cell=cell), "next_time") == want_next
