"""Key filters, insert-only merges and appends on small stores."""

import random

import pytest
from pyspark.sql import functions as F

from gaugework.session import scratch_path
from gaugework.sources import filters, sinks


def frame(spark, keys):
    return spark.createDataFrame([(f"k{k}", k) for k in keys], "key string, v long")


def test_a_filter_knows_its_keys_and_few_others(spark):
    rows = frame(spark, range(5000))
    blocks = filters.block_count(5000)
    assert blocks * filters.WORDS * filters.WORD_BITS >= 20 * 5000 and blocks & (blocks - 1) == 0
    held = filters.key_filter(rows, ["key"], blocks, 1)
    own = filters.seeming_known(rows, ["key"], held, [blocks])
    assert own.select("key").distinct().count() == own.count() == 5000
    strangers = spark.range(5000, 105_000).select(F.concat(F.lit("k"), "id").alias("key"))
    assert filters.seeming_known(strangers, ["key"], held, [blocks]).count() < 100
    beyond = spark.range(1000).select(F.concat(F.lit("z"), "id").alias("key"))  # outside of the bounds
    assert filters.seeming_known(beyond, ["key"], held, [blocks]).count() == 0


def test_parts_read_do_not_grow_with_the_store(spark):
    path, run, draw, known, did = scratch_path(spark, "flat"), sinks.new_run(), random.Random(1), {}, []
    for k in range(12):
        keys = draw.sample(range(10**9), 150) + draw.sample(list(known), min(len(known), 10) if k % 2 else 0)
        did.append(sinks.merge_insert_only(path, frame(spark, keys).withColumn("v", F.lit(k)), ["key"], run, k))
        for x in keys:
            known.setdefault(x, k)
    assert [d.inserted for d in did] == [150] * 12
    assert sum(d.parts_read for d in did[::2]) <= 2 and all(d.parts_read <= 11 for d in did)
    schema = frame(spark, []).schema
    got = {r.key: r.v for r in sinks.read_store(spark, path, schema).collect()}
    assert got == {f"k{x}": k for x, k in known.items()}


def test_batches_by_time_read_what_they_overlap(spark):
    path, run = scratch_path(spark, "time"), sinks.new_run()
    did = []
    for k in range(6):
        rows = spark.range(100 * k - (20 if k else 0), 100 * k + 100).withColumn("v", F.lit(k))
        did.append(sinks.merge_insert_only(path, rows, ["id"], run, k))
    assert [(d.keys, d.inserted, d.parts_read, d.buckets_read) for d in did] == [(100, 100, 0, 0)] + [(120, 100, 1, 1)] * 5


@pytest.mark.parametrize("parts", [1, 3])
def test_two_keys_replays_and_an_empty_batch(spark, parts):
    path, run = scratch_path(spark, "two"), sinks.new_run()
    rows = spark.createDataFrame([(i % 7, str(i), i) for i in range(60)] + [(None, "1", 0), (1, None, 0)], "a int, b string, v int")
    assert sinks.merge_insert_only(path, rows.limit(0), ["a", "b"], run, 0, ["v"], buckets=parts) == sinks.Merged(0, 0, 0, 0)
    for _ in range(2):
        assert sinks.merge_insert_only(path, rows, ["a", "b"], run, 1, ["v"]).inserted == 60
    again = sinks.merge_insert_only(path, rows.withColumn("v", F.lit(-1)), ["a", "b"], sinks.new_run(), 1, ["v"])
    assert (again.keys, again.inserted) == (60, 0)
    assert sinks.merge_insert_only(path, rows.where("a = 0"), ["a", "b"], run, 2, ["v"]).inserted == 0
    got = sinks.read_store(spark, path, rows.schema)
    assert got.count() == 60 and got.where("v < 0").isEmpty() and got.select(sinks.PART).distinct().count() == 1


def test_a_second_append_adds_rows(spark):
    path = scratch_path(spark, "append")

    def piece(first, rows):
        return spark.range(first, first + rows)

    assert sinks.append_batches(piece, 10, 4, path, "one") == 3
    sinks.append_batches(piece, 10, 4, path)
    sinks.append_batches(piece, 10, 4, path, "one")  # repeated after a loss
    assert sinks.read_store(spark, path, spark.range(0).schema).count() == 20
