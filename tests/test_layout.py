"""The Hilbert curve by its defining properties, file skipping, and combined sketches."""

import pytest
from pyspark.sql import functions as F

from gaugework.session import scratch_path
from gaugework.sources import layout, sinks, statistics


@pytest.mark.parametrize(("n", "bits"), [(1, 4), (2, 1), (2, 2), (2, 4), (3, 2), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_differ_by_one_step(spark, n, bits):
    side = 1 << bits
    points = spark.range(side**n).select(*[((F.col("id") / side**i).cast("long") % side).alias(f"c{i}") for i in range(n)])
    rows = points.withColumn("h", layout.hilbert([F.col(f"c{i}") for i in range(n)], bits)).collect()
    by = {r.h: tuple(r)[:n] for r in rows}
    assert sorted(by) == list(range(side**n))
    assert all(sum(abs(a - b) for a, b in zip(by[k], by[k + 1])) == 1 for k in range(side**n - 1))


def test_ranks_are_by_count(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id") * F.col("id")).alias("v"))
    cuts = [i * i for i in range(125, 1000, 125)]
    got = df.select(layout.equal_count_rank(F.col("v"), cuts, 3).alias("r")).groupBy("r").count().collect()
    assert {r.r: r["count"] for r in got} == dict.fromkeys(range(8), 125)


def test_boxes_need_few_files_for_either_key(spark):
    df = spark.range(40_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)), 3).alias("b"), "id")
    path = scratch_path(spark, "hilbert")
    stored = sinks.save_table(layout.hilbert_layout(df.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), ["a", "b"], 64), path)
    assert stored.count() == 40_000 and stored.columns == ["a", "b", "id"]
    boxes = {"both": {"a": (300, 400), "b": (300.0**3, 400.0**3)}, "a": {"a": (300, 400)}, "b": {"b": (300.0**3, 400.0**3)}, "all": {}}
    share = {r.box: r.share for r in layout.files_needed(layout.file_bounds(stored, ["a", "b"]), boxes).collect()}
    assert share["both"] <= 0.15 and share["a"] <= 0.35 and share["b"] <= 0.35 and share["all"] == 1.0
    sorted_files = sinks.save_table(df.repartitionByRange(64, "a").sortWithinPartitions("a"), scratch_path(spark, "sorted"))
    plain = {r.box: r.share for r in layout.files_needed(layout.file_bounds(sorted_files, ["a", "b"]), boxes).collect()}
    assert plain["b"] == 1.0


def test_layout_edges(spark):
    none = spark.createDataFrame([(None, 1), (None, 2)], "a int, b int")
    assert layout.hilbert_layout(none, ["a", "b"], 4).count() == 2
    assert layout.hilbert_layout(none.limit(0), ["a", "b"], 4).count() == 0
    with pytest.raises(ValueError, match="percentiles"):
        layout.hilbert_layout(spark.createDataFrame([("x",)], "s string"), ["s"], 2)
    with pytest.raises(ValueError, match="bits"):
        layout.hilbert([F.lit(1)] * 9, 8)


def test_sketches_of_batches_equal_one_pass(spark):
    df = spark.range(60_000).select((F.col("id") % 7000).alias("k"), (F.col("id") * 1.5).alias("v"), F.lit(None).cast("string").alias("n"), F.concat(F.lit("w"), F.least(F.col("id") % 9, F.lit(4))).alias("w"))
    columns, one, many = df.columns, scratch_path(spark, "one"), scratch_path(spark, "many")
    statistics.add_batch(df, columns, one, "all")
    for k, low in enumerate((0, 10_000, 45_000, 10_000)):  # the last one again
        high = (10_000, 45_000, 60_000, 45_000)[k]
        statistics.add_batch(df.where((F.col("v") >= low * 1.5) & (F.col("v") < high * 1.5)), columns, many, "0121"[k])
    statistics.add_batch(df.limit(0), columns, many, "empty")
    a, b = ({r.column_name: r for r in statistics.combined(spark, p).collect()} for p in (one, many))
    for c, exact in (("k", 7000), ("v", 60_000), ("n", 0), ("w", 5)):
        assert tuple(a[c])[:5] == tuple(b[c])[:5] and a[c].rows == 60_000 and abs(a[c].distinct_values - b[c].distinct_values) <= 0.01 * exact
        assert abs(b[c].distinct_values - exact) <= statistics.DISTINCT_ERROR * exact
    assert b["n"].nulls == 60_000 and b["n"].quantiles is None and b["n"].frequent == []
    assert all(abs(x / 90_000 - q) <= statistics.RANK_ERROR for x, q in zip(b["v"].quantiles, statistics.QUANTILES))
    assert {(r["item"], r["count"]) for r in b["w"].frequent} == {(f"w{i}", n) for i, n in enumerate((6667, 6667, 6667, 6667, 33332))}
