"""Summaries kept by deltas, and the choice of the one that answers."""

import pytest
from pyspark.sql import functions as F

from gaugework.plans import summaries as sums
from gaugework.plans.semantic import MetricView
from gaugework.session import scratch_path

ROWS = "id int, area string, year int, v double"


def rows(spark, *some):
    return spark.createDataFrame(list(some), ROWS)


def definition(source):
    view = MetricView(source, {"area": "source.area", "year": "source.year"}, {}, filter="source.v IS NOT NULL")
    partials = {
        "n": sums.Partial("count(1)"), "total": sums.Partial("sum(source.v)"), "top": sums.Partial("max(source.v)", "max"),
        "ids": sums.Partial("count(distinct source.id)", None),
    }
    return sums.Definition(view, partials, {"n": "n", "mean": "total / n", "top": "top", "ids": "ids"})


FIRST = [(1, "a", 2001, 1.0), (2, "a", 2001, 3.0), (3, "b", 2001, 5.0), (4, "b", 2002, 7.0), (5, "01", 2003, 9.0), (6, None, 2003, 1.0)]


def files(spark, stored):
    found = stored.groups(spark).select(stored.partition, F.input_file_name().alias("f")).distinct().collect()
    return {r[0]: {x["f"] for x in found if x[0] == r[0]} for r in found}


def test_deltas_equal_a_rebuild_and_leave_other_partitions(spark):
    source = rows(spark, *FIRST)
    d = definition(source)
    kept = sums.store(d, scratch_path(spark, "sum"), ["area", "year"], ["n", "total"], "year")
    before = files(spark, kept)
    added, gone = rows(spark, (7, "a", 2002, 2.0), (8, "c", 2002, 4.0)), rows(spark, (4, "b", 2002, 7.0))
    change = sums.delta(d, kept, added, gone)
    assert sums.apply_delta(d, kept, change, "one") and not sums.apply_delta(d, kept, change, "one")
    after = files(spark, kept)
    assert {y for y in before if before[y] == after[y]} == {2001, 2003}
    want = sums.summarise(d, ["area", "year"], ["n", "total"], source.where("id <> 4").unionByName(added))
    columns = ["area", "year", "n", "total"]
    assert sorted(map(tuple, kept.read(spark).select(columns).collect()), key=repr) == sorted(map(tuple, want.select(columns).collect()), key=repr)


def test_a_delta_that_broke_off_is_published_again(spark, monkeypatch):
    d = definition(rows(spark, *FIRST))
    kept = sums.store(d, scratch_path(spark, "sum"), ["area", "year"], ["n", "total"], "year")
    change = sums.delta(d, kept, rows(spark, (9, "a", 2001, 6.0)))
    mark = sums._mark

    def broken(session, path):
        if "_applied" in path:
            raise RuntimeError("lost")
        mark(session, path)

    monkeypatch.setattr(sums, "_mark", broken)
    with pytest.raises(RuntimeError, match="lost"):
        sums.apply_delta(d, kept, change, "nine")  # published, but not noted
    monkeypatch.setattr(sums, "_mark", mark)
    assert sums.apply_delta(d, kept, change, "nine")
    got = {(r.area, r.year): (r.n, r.total) for r in kept.read(spark).collect()}
    assert got[("a", 2001)] == (3, 10.0)


def test_partitions_and_groups_may_become_empty_or_null(spark):
    d = definition(rows(spark, *FIRST))
    kept = sums.store(d, scratch_path(spark, "sum"), ["area"], ["n", "total"], "area")
    assert {r.area for r in kept.read(spark).collect()} == {"a", "b", "01", None}
    sums.apply_delta(d, kept, sums.delta(d, kept, removed=rows(spark, *FIRST[4:])), "gone")
    assert {r.area: r.n for r in kept.read(spark).collect()} == {"a": 2, "b": 2}


def test_the_smallest_grain_that_can_answer(spark):
    d = definition(rows(spark, *FIRST))
    base = scratch_path(spark, "sum")
    by_both = sums.store(d, f"{base}/both", ["area", "year"], ["n", "total", "top"], "year")
    by_year = sums.store(d, f"{base}/year", ["year"], ["n", "total"], "year")
    stores = {s: s.read(spark).count() for s in (by_both, by_year)}
    assert sums.covering(d, stores, ["year"], ["mean"]) is by_year
    assert sums.covering(d, stores, ["year"], ["top"]) is by_both
    assert sums.covering(d, stores, ["year"], ["n"], ["area"]) is by_both
    assert sums.covering(d, stores, ["year"], ["ids"]) is None  # distinct counts don't add up
    out = sums.answer(spark, d, stores, ["year"], ["n", "mean"], {"area": ["a", "b"]})
    assert "both" in " ".join(out.inputFiles()) and {r.year: (r.n, r.mean) for r in out.collect()} == {2001: (3, 3.0), 2002: (1, 7.0)}
    for measures in (["n", "mean"], ["ids"]):
        from_source = sums.answer(spark, d, {}, ["year"], measures, {"area": ["a", "b"]}).collect()
        assert len(from_source) == 2
    assert {r.year: r.ids for r in sums.answer(spark, d, stores, ["year"], ["ids"]).collect()} == {2001: 3, 2002: 1, 2003: 2}


def test_refusals(spark):
    d = definition(rows(spark, *FIRST))
    with pytest.raises(ValueError, match="add up"):
        sums.store(d, scratch_path(spark, "sum"), ["year"], ["ids"], "year")
    kept = sums.store(d, scratch_path(spark, "sum"), ["year"], ["top"], "year")
    with pytest.raises(ValueError, match="taken out"):
        sums.delta(d, kept, removed=rows(spark, *FIRST))
    with pytest.raises(ValueError, match="unknown"):
        sums.answer(spark, d, {kept: 3}, ["month"], ["n"])
    with pytest.raises(ValueError, match="unknown"):
        sums.answer(spark, d, {kept: 3}, ["year"], ["other"])
