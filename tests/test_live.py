"""Point-in-time features and outcomes of streams, in several arrivals."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugework.session import scratch_path
from gaugework.streaming import ingest, outcomes, snapshots as live

START = datetime(2024, 1, 1)
ROWS = "asset_id long, event_time timestamp, kind string, id long, value double"


def events():
    draw, out = random.Random(2), []
    for i in range(500):
        at = START + timedelta(minutes=draw.randrange(12 * 24 * 60))
        kind = draw.choices([live.TELEMETRY, live.FAILURE, live.METER, live.UPKEEP], [10, 2, 2, 1])[0]
        out.append((draw.choice([1, 1, 1, 2, 3]), at, kind, i, float(draw.randrange(100))))
    return sorted(out, key=lambda r: r[1])


def by_definition(rows, now):
    """Rows by asset and window end, straight from the rules."""
    day, out = timedelta(days=1), {}
    for asset in {r[0] for r in rows}:
        own = {k: [r for r in rows if r[0] == asset and r[2] == k] for k in (live.TELEMETRY, live.FAILURE, live.METER, live.UPKEEP)}
        for g in range(1, 14):
            end = START + g * day
            values = [r for r in own[live.TELEMETRY] if end - day <= r[1] < end]
            if not values or end > now:
                continue
            meters = [r for r in own[live.METER] if r[1] <= end]
            done = [r[1] for r in own[live.UPKEEP] if r[1] <= end]
            failed = sorted({r[1] for r in own[live.FAILURE]})
            ahead = [f for f in failed if end < f <= end + 2 * day]
            ripe = end + 2 * day <= now
            mean = sum(r[4] for r in values) / len(values)
            first, last = (f(values, key=lambda r: (r[1], r[3]))[4] for f in (min, max))
            out[asset, end] = (
                len(values), round(mean, 6), min(r[4] for r in values), max(r[4] for r in values), round((last - first) / 24, 6),
                sum(r[4] > 70 for r in values), max(meters, key=lambda r: (r[1], r[3]))[4] if meters else None,
                round((end - max(done)) / timedelta(hours=1), 6) if done else None, sum(end - 5 * day <= f < end for f in failed),
                min(ahead, default=None) if ripe else None, int(bool(ahead)) if ripe else None,
            )
    return out


@pytest.mark.parametrize("arrivals", [1, 4])
def test_features_and_labels_in_any_arrival(spark, arrivals):
    rows, base = events(), scratch_path(spark, "live")
    now = rows[-1][1] - timedelta(hours=6)
    shape = live.Shape.of("24 hours", "48 hours", "5 days")
    size = -(-len(rows) // arrivals)
    draw, late = random.Random(arrivals), []
    for k in range(arrivals):
        part = rows[k * size : (k + 1) * size]
        # some of each part come with the next one, late by less than the delay allows
        held = [r for r in part if part[-1][1] - r[1] < timedelta(hours=5) and draw.random() < 0.5] if k + 1 < arrivals else []
        arrived, late = [r for r in part if r not in held] + late, held
        draw.shuffle(arrived)
        spark.createDataFrame(arrived, ROWS).coalesce(1).write.mode("append").parquet(f"{base}/in")
        with live.large_state(spark):
            stream = spark.readStream.schema(spark.createDataFrame([], ROWS).schema).parquet(f"{base}/in")
            ingest.append_table(live.point_in_time(stream, shape), f"{base}/out", f"{base}/checkpoint")
    got = live.labelled(spark.read.parquet(f"{base}/out")).collect()
    want = by_definition(rows, now)
    found = {
        (r.asset_id, r.feature_time): (
            r.telemetry_count, round(r.value_mean, 6), r.value_min, r.value_max, round(r.value_slope, 6), r.value_spike_count, r.operating_hours,
            None if r.hours_since_maintenance is None else round(r.hours_since_maintenance, 6), r.failures_last_90d, r.label_failure_time, r.label_failure_within_horizon,
        )
        for r in got
    }
    assert len(got) == len(found) and found == want
    assert any(v[-1] == 1 for v in want.values()) and any(v[-1] is None for v in want.values())


def test_cells_merge_in_any_order():
    one = (2, 3.0, 2.0, 2.0, 4.0, 0, 10, 1, 2.0, 20, 2, 4.0)
    two = (1, 9.0, 0.0, 9.0, 9.0, 1, 5, 7, 9.0, 5, 7, 9.0)
    both = live.merged(one, two)
    assert both == live.merged(two, one) == (3, 5.0, 26.0, 2.0, 9.0, 1, 5, 7, 9.0, 20, 2, 4.0)


class Handle:
    """State of one asset that counts how often it is called."""

    def __init__(self):
        self.calls, self.kept, self.timers = 0, None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.kept

    def update(self, value):
        self.calls, self.kept = self.calls + 1, value

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class Now:
    def __init__(self, at):
        self.ms = int((at - datetime(1970, 1, 1)) / timedelta(milliseconds=1))

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_many_windows_of_an_asset_cost_one_call_each_way(spark):
    """A batch reads and writes the state of an asset once and sets one timer, however many windows and failures it has."""
    rows = [(7, START + timedelta(hours=3 * i), kind, i, 1.0) for i in range(240) for kind in (live.TELEMETRY, live.FAILURE, live.METER, live.UPKEEP)]
    shape, day = live.Shape.of("24 hours", "48 hours", "5 days"), timedelta(days=1)
    stream = spark.createDataFrame(rows, ROWS).select("*", F.unix_micros("event_time").alias("us")).coalesce(1)
    parts = live.merge_parts(stream, shape).collect()
    assert len(parts) == 1 and parts[0].us == max(epoch_us(r[1]) for r in rows)
    one, handle = live.PointInTime(shape), Handle()
    one.init(handle)
    assert list(one.handleInputRows((7,), iter(parts), Now(START))) == []
    assert handle.calls == 3 and len(handle.timers) == 1
    (out,) = one.handleExpiredTimer((7,), Now(START + 20 * day), None)
    assert handle.calls == 6 and len(out.snapshots) == 20 * live._SNAPSHOTS.rows.size and len(out.labels) == 18 * live._LABELS.rows.size
    # a stale timer finds nothing; the windows that were emitted are not opened again by rows that come too late
    assert list(one.handleExpiredTimer((7,), Now(START + 20 * day), None)) == []
    list(one.handleInputRows((7,), iter(parts), Now(START + 20 * day)))
    (out,) = one.handleExpiredTimer((7,), Now(START + 60 * day), None)
    assert len(out.snapshots) == 10 * live._SNAPSHOTS.rows.size and len(out.labels) == 12 * live._LABELS.rows.size
    assert not live.Asset(handle.kept).failed and live.Asset(handle.kept).wake is None


def epoch_us(at):
    return (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)


@pytest.mark.parametrize("kind", [live.TELEMETRY, live.FAILURE, live.METER, live.UPKEEP, "other"])
def test_parts_of_one_kind(spark, kind):
    rows = [("a", START, kind, None, 1.0), ("a", START + timedelta(hours=1), kind, 2, 3.0), ("b", START, kind, 1, None)]
    stream = spark.createDataFrame(rows, ROWS.replace("asset_id long", "asset_id string")).select("*", F.unix_micros("event_time").alias("us"))
    parts = {r.asset_id: r for r in live.merge_parts(stream.coalesce(1), live.Shape.of()).collect()}
    assert sorted(parts) == ([] if kind == "other" else ["a", "b"])
    if kind == live.TELEMETRY:
        ((_, n, mean, m2, *_),) = live._CELLS.rows.iter_unpack(parts["a"].cells)
        assert (n, mean, m2) == (2, 2.0, 2.0)
    elif kind != "other":
        name, layout = live._PARTS[kind]
        assert len(parts["a"][name]) == layout.rows.size * 2


def test_rows_that_come_after_their_window_closed(spark):
    """A late row beside rows in time doesn't give a second snapshot of its window."""
    base, hour = scratch_path(spark, "late"), timedelta(hours=1)
    for part in ([(1, START + 2 * hour, 5.0), (1, START + 40 * hour, 6.0)], [(1, START + 3 * hour, 7.0), (1, START + 41 * hour, 8.0), (2, START + 90 * hour, 9.0)]):
        rows = [(asset, at, live.TELEMETRY, i, value) for i, (asset, at, value) in enumerate(part)]
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{base}/in")
        with live.large_state(spark):
            stream = spark.readStream.schema(spark.read.parquet(f"{base}/in").schema).parquet(f"{base}/in")
            ingest.append_table(live.point_in_time(stream, live.Shape.of()), f"{base}/out", f"{base}/checkpoint")
    got = live.labelled(spark.read.parquet(f"{base}/out")).orderBy("feature_time").collect()
    assert [(r.asset_id, r.feature_time, r.telemetry_count, r.value_max) for r in got] == [(1, START + 24 * hour, 1, 5.0), (1, START + 48 * hour, 2, 8.0)]


def test_outcomes_of_early_and_late_failures(spark):
    base, hour = scratch_path(spark, "outcomes"), timedelta(hours=1)
    predicted = [(i, 1 + i % 2, START + i * hour, 24, 0.9 if i % 3 else 0.1, 0.5) for i in range(8)]
    failed = [(1, START + 5 * hour), (1, START + 5 * hour), (1, START + 6 * hour), (2, START + 40 * hour), (9, START + 80 * hour)]
    spark.createDataFrame(failed, "machine_id long, failure_time timestamp").write.parquet(f"{base}/failures")
    ddl = "prediction_id long, asset_id long, prediction_time timestamp, forecast_horizon_hours int, failure_probability double, threshold_used double"
    last = (99, 9, START + 80 * hour, 24, 0.9, 0.5)  # moves the watermark on
    spark.createDataFrame([*predicted, last], ddl).write.parquet(f"{base}/predictions")
    streams = [spark.readStream.schema(spark.read.parquet(f"{base}/{x}").schema).parquet(f"{base}/{x}") for x in ("predictions", "failures")]
    ingest.append_table(outcomes.matches(*streams, "24 hours"), f"{base}/out", f"{base}/checkpoint")
    got = outcomes.closed(spark.read.parquet(f"{base}/out"), F.lit(START + 60 * hour)).collect()
    want = {}
    for i, asset, at, *_ in predicted:
        ahead = [f for m, f in failed if m == asset and at < f <= at + 24 * hour]
        want[i] = min(ahead, default=None)
    assert {r.prediction_id: r.actual_failure_time for r in got} == want and len(got) == 8
    assert {r.outcome_class for r in got} == {"true_positive", "false_positive", "false_negative", "true_negative"}
