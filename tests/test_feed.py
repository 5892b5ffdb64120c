"""Streams that are read by ranges of time: cursor, overlap, backfill, restarts."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugework.session import scratch_path
from gaugework.sources import feed
from gaugework.sources.sinks import read_store
from gaugework.streaming import ingest

START = datetime(2024, 1, 1)
DDL = "id long, ts timestamp_ntz, v string"


@pytest.fixture
def base(spark):
    return scratch_path(spark, "feed").removeprefix("file:")


def drop(spark, base, rows):
    """``rows`` of (id, hours after the start or None)."""
    data = [(i, None if h is None else START + timedelta(hours=h), f"v{i}") for i, h in rows]
    # one more column than the stream declares
    spark.createDataFrame(data, DDL).withColumn("more", F.lit(1)).repartition(2).write.mode("append").parquet(f"{base}/feed")


def take(spark, base, **options):
    """One catch-up; returns the ids that its batches held, known ones too."""
    held = []
    sink = ingest.insert_only_sink(f"{base}/store", f"{base}/progress", ["id"], (), lambda batch: batch)

    def note(batch, batch_id):
        held.extend(r.id for r in batch.collect())
        sink(batch, batch_id)

    ingest.catch_up(feed.range_stream(spark, f"{base}/feed", DDL, "ts", **options), note, f"{base}/progress")
    return sorted(held)


def stored(spark, base):
    return sorted((r.id, r.ts, r.v) for r in read_store(spark, f"{base}/store", spark.createDataFrame([], DDL).schema).collect())


def ids(spark, base):
    return [r[0] for r in stored(spark, base)]


def test_backfill_then_cursor_less_overlap(spark, base):
    drop(spark, base, [(1, 0), (2, 30), (3, 100), (4, None)])
    assert take(spark, base, backfill="3 days") == [2, 3]  # 0 lies before the backfill; no instant, never read
    # 5 is late within the overlap, 6 later than that allows, 7 and 8 are new
    drop(spark, base, [(5, 95), (6, 93), (7, 100), (8, 2000)])
    assert take(spark, base, backfill="3 days") == [3, 5, 7, 8]
    assert stored(spark, base)[0] == (2, START + timedelta(hours=30), "v2")
    assert ids(spark, base) == [2, 3, 5, 7, 8]


def test_nothing_new_is_no_batch_and_late_rows_are_one(spark, base):
    drop(spark, base, [(1, 10)])
    assert take(spark, base) == [1]
    assert take(spark, base) == []
    drop(spark, base, [(2, 9)])  # older than the cursor: only the count of rows tells
    assert take(spark, base) == [1, 2]
    assert ids(spark, base) == [1, 2]


def test_a_lost_commit_repeats_nothing(spark, base):
    drop(spark, base, [(1, 0), (2, 5)])
    take(spark, base)
    drop(spark, base, [(3, 6), (4, 50)])
    take(spark, base)
    before = stored(spark, base)
    for name in ("1", ".1.crc"):  # the second batch was stored, but its commit did not get through
        Path(f"{base}/progress/commits/{name}").unlink(missing_ok=True)
    drop(spark, base, [(5, 60)])
    assert take(spark, base) == [1, 2, 3, 4]  # the same range again, whatever has come since
    assert stored(spark, base) == before
    assert take(spark, base) == [4, 5]
    assert stored(spark, base)[:4] == before and ids(spark, base) == [1, 2, 3, 4, 5]


def test_empty_and_missing_folder(spark, base):
    assert take(spark, base) == []
    drop(spark, base, [(1, None)])
    assert take(spark, base) == []
    drop(spark, base, [(2, 1)])
    assert take(spark, base) == [2]


def test_repeated_rows_and_ties_are_read_whole(spark, base):
    drop(spark, base, [(1, 1), (1, 1), (2, 1)])
    assert take(spark, base) == [1, 1, 2]
    assert ids(spark, base) == [1, 2]


def test_chunks_become_tasks_and_hot_chunks_several():
    reader = feed.RangeReader(None, "", "ts", 0, feed.span("90 days"), "30 days")
    day = 86_400_000_000
    reader.groups = lambda: [feed.Group("a", i, feed.ROWS_PER_TASK // 2, 70 * day, 80 * day) for i in range(5)] + [feed.Group("b", 0, 10, 0, 90 * day)]
    parts = reader.partitions({"cursor": None, "rows": 0}, {"cursor": 90 * day, "rows": 1})
    spans = sorted({(p.low // day, p.high // day) for p in parts})
    assert spans[:3] == [(0, 30), (30, 60), (60, 90)]
    hot = [p for p in parts if p.low // day == 60]
    assert len(hot) == 3 and sorted(n for p in hot for path, ns in p.groups if path == "a" for n in ns) == [0, 1, 2, 3, 4]


def test_instants_without_bounds_are_refused(spark, base):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        spark.sql("SELECT 1L AS id, timestamp'2024-01-01 00:00:00' AS ts, 'x' AS v").write.parquet(f"{base}/feed")
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    reader = feed.RangeReader(None, f"{base}/feed", "ts", 0, 1, "30 days")
    with pytest.raises(ValueError, match="without bounds"):
        reader.latestOffset()
