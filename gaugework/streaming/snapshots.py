"""Point-in-time features and labels over live appends.

Rows of all sources arrive in one stream, in any order within the watermark's delay. Tasks first merge what they
read of an asset into one row, with a cell per window, so that a hot asset sends few rows. State per asset holds the
windows that are still open, the newest meter reading and completed maintenance, and the failures of the history span.
Each call of the state costs a round trip between Python and the JVM, so an asset has one state value, read and written
once a batch, and one event-time timer at the next instant at which something of it is due: a window that closes and
gives its features, one horizon later its label. When nothing is open, the timer waits for the last failure to expire.
So a label is 1 or 0 only once its horizon has passed in the data, and nothing is emitted twice.

Between the steps rows are packed (little-endian numbers without gaps): what falls due of an asset leaves the state as
one value and is unpacked by the column. What falls due in a partition at once leaves it as one Arrow batch.

Rows that come later than the watermark allows are dropped: by Spark, if all that their task merged of the asset is
late, else if their window has closed. Rows without asset, time or (telemetry) value are left out; windows and labels
that are open when the input ends wait in the checkpoint for the next run.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from struct import Struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.when import hours, instant, micros, span

TELEMETRY, FAILURE, METER, UPKEEP = "telemetry", "failure", "meter", "upkeep"
_CELL = "n long, mean double, m2 double, low double, high double, spikes long, first_us long, first_id long, first double, last_us long, last_id long, last double"
_LONG_MAX = (1 << 63) - 1
_NEVER = -(1 << 63)  # an instant that isn't known; doubles that aren't are NaN
_MERGE_ROWS = 200_000  # rows that a task merges at once


class Packed:
    """Rows of the fields as bytes, for Python (``rows``) and for numpy (``dtype``)."""

    def __init__(self, fields: str):
        self.fields, pairs = fields, [x.split() for x in fields.split(", ")]
        self.rows = Struct("<" + "".join("q" if kind == "long" else "d" for _, kind in pairs))
        self.dtype = np.dtype([(name, "<i8" if kind == "long" else "<f8") for name, kind in pairs])

    def __reduce__(self):
        return Packed, (self.fields,)


_SNAPSHOT, _LABEL = f"g long, {_CELL}, operating_hours double, done long, failures_last_90d long", "g long, failed long"
_CELLS, _READINGS, _READING, _DONE, _INSTANTS = map(Packed, (f"g long, {_CELL}", "g long, us long, id long, value double", "us long, id long, value double", "g long, us long", "us long"))
_SNAPSHOTS, _LABELS = Packed(_SNAPSHOT), Packed(_LABEL)
_OUT = Row("asset_id", "snapshots", "labels")
_STATE = "cells binary, meters binary, upkeep binary, failed binary, unlabelled binary, meter binary, done long, closed long, wake long"
#: What a task sends of each kind: cells of windows, the newest of each window, instants.
_PARTS = {TELEMETRY: ("cells", _CELLS), METER: ("meters", _READINGS), UPKEEP: ("upkeep", _DONE), FAILURE: ("failed", _INSTANTS)}


@dataclass(frozen=True)
class Shape:
    """Spans in microseconds and the spike threshold of the measured value."""

    width: int
    horizon: int
    history: int
    spike_above: float

    @classmethod
    def of(cls, window: str = "24 hours", horizon: str = "168 hours", history: str = "90 days", spike_above: float = 70.0) -> Shape:
        return cls(span(window), span(horizon), span(history), spike_above)


def merged(a: tuple, b: tuple) -> tuple:
    """Statistics of the rows of two cells together; moments by their means, not by sums of squares."""
    n, apart = a[0] + b[0], b[1] - a[1]
    mean = a[1] + apart * b[0] / n
    m2 = a[2] + b[2] + apart * apart * a[0] * b[0] / n
    return (n, mean, m2, min(a[3], b[3]), max(a[4], b[4]), a[5] + b[5], *min(a[6:9], b[6:9]), *max(a[9:12], b[9:12]))


def merge_parts(stream: DataFrame, shape: Shape) -> DataFrame:
    """Rows (asset_id, us, kind, id, value) merged by asset, kind and window within what a task reads at once.

    Gives a row per asset: its latest instant ``us`` and the packed parts of each kind.
    """

    def cells(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(g=rows["us"] // shape.width + 1, spike=rows["value"] > shape.spike_above).sort_values(["us", "id"])
        keys = ["asset", "g"]
        apart = rows["value"] - rows.groupby(keys, sort=False)["value"].transform("mean")
        out = rows.assign(square=apart * apart).groupby(keys, sort=False).agg(
            n=("value", "size"), mean=("value", "mean"), m2=("square", "sum"),
            low=("value", "min"), high=("value", "max"), spikes=("spike", "sum"), first_us=("us", "first"), first_id=("id", "first"),
            first=("value", "first"), last_us=("us", "last"), last_id=("id", "last"), last=("value", "last"),
        )
        return out.reset_index()

    def newest(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(g=-(-rows["us"] // shape.width)).sort_values(["us", "id"])
        return rows.drop_duplicates(["asset", "g"], keep="last")

    def once(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.drop_duplicates(["asset", "us"])

    merge = {TELEMETRY: cells, METER: newest, UPKEEP: newest, FAILURE: once}

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["kind"].isin(list(merge)) & rows["asset_id"].notna()]
        codes, assets = pd.factorize(rows["asset_id"])
        rows = rows.assign(asset=codes)
        out = {"asset_id": assets, "us": rows.groupby("asset")["us"].max().to_numpy()}
        for kind, (name, layout) in _PARTS.items():
            part = merge[kind](rows[rows["kind"] == kind]).sort_values("asset")
            table = np.empty(len(part), layout.dtype)
            for field in layout.dtype.names:
                table[field] = part[field]
            ends = np.searchsorted(part["asset"].to_numpy(), np.arange(len(assets) + 1)) * layout.dtype.itemsize
            raw = table.tobytes()
            out[name] = [raw[i:j] for i, j in zip(ends[:-1], ends[1:])]
        return pd.DataFrame(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= _MERGE_ROWS:
                yield packed(pd.concat(held))
                held, rows = [], 0
        if rows:
            yield packed(pd.concat(held))

    kind = stream.schema["asset_id"].dataType.simpleString()
    ordered = F.coalesce("id", F.lit(_LONG_MAX)).alias("id")  # rows without an id come last in their instant
    parts = ", ".join(f"{name} binary" for name, _ in _PARTS.values())
    return stream.select("asset_id", "us", "kind", ordered, "value").mapInPandas(run, f"asset_id {kind}, us long, {parts}")


class Asset:
    """What is known of an asset; packed, it is the state."""

    def __init__(self, state: tuple | None):
        cells, meters, upkeep, failed, unlabelled, meter, self.done, closed, self.wake = state or (b"",) * 5 + (None,) * 4
        self.cells = {g: tuple(x) for g, *x in _CELLS.rows.iter_unpack(cells)}
        self.meters = {g: tuple(x) for g, *x in _READINGS.rows.iter_unpack(meters)}
        self.upkeep = dict(_DONE.rows.iter_unpack(upkeep))
        self.failed, self.unlabelled = ({x for (x,) in _INSTANTS.rows.iter_unpack(y)} for y in (failed, unlabelled))
        self.meter = None if meter is None else _READING.rows.unpack(meter)
        self.closed = _NEVER if closed is None else closed

    def state(self) -> tuple:
        cells = b"".join(_CELLS.rows.pack(g, *x) for g, x in self.cells.items())
        meters = b"".join(_READINGS.rows.pack(g, *x) for g, x in self.meters.items())
        upkeep = b"".join(_DONE.rows.pack(*x) for x in self.upkeep.items())
        failed, unlabelled = (b"".join(map(_INSTANTS.rows.pack, x)) for x in (self.failed, self.unlabelled))
        meter = None if self.meter is None else _READING.rows.pack(*self.meter)
        return cells, meters, upkeep, failed, unlabelled, meter, self.done, self.closed, self.wake

    def add(self, row: Row, width: int) -> None:
        """What a task sent; cells of windows that have been emitted are too late."""
        for g, *cell in _CELLS.rows.iter_unpack(row["cells"]):
            if g * width > self.closed:
                self.cells[g] = merged(self.cells[g], tuple(cell)) if g in self.cells else tuple(cell)
        for g, *new in _READINGS.rows.iter_unpack(row["meters"]):
            if g not in self.meters or self.meters[g][:2] < tuple(new[:2]):
                self.meters[g] = tuple(new)
        for g, us in _DONE.rows.iter_unpack(row["upkeep"]):
            self.upkeep[g] = max(us, self.upkeep.get(g, us))
        self.failed.update(us for (us,) in _INSTANTS.rows.iter_unpack(row["failed"]))

    def due(self, shape: Shape) -> int | None:
        """The next instant at which something closes, matures or expires."""
        ends = [g * shape.width for g in self.cells] + [g * shape.width + shape.horizon for g in self.unlabelled]
        if not ends and self.failed:
            ends = [max(self.failed) + shape.history + 1000]
        return min(ends, default=None)

    def close(self, shape: Shape, now: int) -> bytes:
        """Snapshots of the windows that end up to now, in their order."""
        out, failures = [], sorted(self.failed)
        readings, upkeep = sorted(self.meters, reverse=True), sorted(self.upkeep, reverse=True)
        for g in sorted(g for g in self.cells if g * shape.width <= now):
            end = g * shape.width
            while readings and readings[-1] <= g:
                new = self.meters.pop(readings.pop())
                self.meter = new if self.meter is None or new[:2] > self.meter[:2] else self.meter
            while upkeep and upkeep[-1] <= g:
                new = self.upkeep.pop(upkeep.pop())
                self.done = new if self.done is None else max(self.done, new)
            recent = bisect_left(failures, end) - bisect_left(failures, end - shape.history)
            hours_run, done = float("nan") if self.meter is None else self.meter[2], _NEVER if self.done is None else self.done
            out.append(_SNAPSHOTS.rows.pack(g, *self.cells.pop(g), hours_run, done, recent))
            self.unlabelled.add(g)
        self.closed = now
        return b"".join(out)

    def ripen(self, shape: Shape, now: int) -> bytes:
        """Labels of the windows whose horizon ends up to now; failures before the history span are forgotten."""
        out, failures = [], sorted(self.failed)
        for g in sorted(g for g in self.unlabelled if g * shape.width + shape.horizon <= now):
            end, after = g * shape.width, bisect_right(failures, g * shape.width)
            ahead = failures[after] if after < len(failures) and failures[after] <= end + shape.horizon else _NEVER
            out.append(_LABELS.rows.pack(g, ahead))
            self.unlabelled.remove(g)
        self.failed = set(failures[bisect_left(failures, now - shape.history) :])
        return b"".join(out)


class PointInTime(StatefulProcessor):
    """Windows of one asset: closed, labelled and forgotten by event time."""

    def __init__(self, shape: Shape):
        self.shape = shape

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", _STATE)

    def _keep(self, asset: Asset) -> None:
        """Store the asset, with a timer unless one is set that comes before. A timer that comes too early finds nothing."""
        due = asset.due(self.shape)
        if due is not None and (asset.wake is None or -(-due // 1000) < asset.wake):
            asset.wake = -(-due // 1000)
            self.handle.registerTimer(asset.wake)
        self.kept.update(asset.state())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        asset = Asset(self.kept.get())
        for row in rows:
            asset.add(row, self.shape.width)
        self._keep(asset)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Everything that is due at the watermark; later timers of the same instant find nothing."""
        asset, now = Asset(self.kept.get()), timerValues.getCurrentWatermarkInMs() * 1000
        if asset.wake is None or asset.wake * 1000 > now:
            return
        asset.wake = None
        snapshots = asset.close(self.shape, now)
        labels = asset.ripen(self.shape, now)
        self._keep(asset)
        if snapshots or labels:
            yield _OUT(*key, snapshots, labels)


def unpacked(found: DataFrame) -> DataFrame:
    """``what, asset_id``, and the fields of packed snapshots and labels, a row for each."""
    layouts = {"snapshot": ("snapshots", _SNAPSHOTS.dtype), "label": ("labels", _LABELS.dtype)}
    fields = {**_SNAPSHOTS.dtype.fields, **_LABELS.dtype.fields}

    def rows_of(what: str, batch: pa.RecordBatch) -> pa.RecordBatch:
        name, dtype = layouts[what]
        raw = batch.column(name).to_pylist()
        rows = np.frombuffer(b"".join(raw), dtype)
        asset = np.repeat(np.arange(len(raw)), [len(x) // dtype.itemsize for x in raw])
        out = {"what": pa.array([what] * len(rows), pa.string()), "asset_id": batch.column("asset_id").take(pa.array(asset))}
        for field, (numbers, *_) in fields.items():
            if field in dtype.names:
                x = np.ascontiguousarray(rows[field])
                out[field] = pa.array(x, mask=np.isnan(x) if numbers.kind == "f" else x == _NEVER)
            else:
                out[field] = pa.nulls(len(rows), pa.from_numpy_dtype(numbers))
        return pa.RecordBatch.from_pydict(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for what in layouts:
                    yield rows_of(what, batch.slice(at, 256))

    kind = found.schema["asset_id"].dataType.simpleString()
    return found.mapInArrow(run, f"what string, asset_id {kind}, {_SNAPSHOT}, failed long")


def point_in_time(stream: DataFrame, shape: Shape, late: str = "6 hours") -> DataFrame:
    """Snapshots and labels of a stream (asset_id, event_time, kind, id, value) as they fall due.

    ``kind`` is telemetry (id breaks ties of time), failure, meter or upkeep.
    """
    known = stream.where("asset_id IS NOT NULL AND event_time IS NOT NULL AND (kind <> 'telemetry' OR value IS NOT NULL)")
    parts = merge_parts(known.withColumn("us", micros("event_time")), shape)
    timed = parts.withColumn("event_time", F.timestamp_micros("us")).drop("us").withWatermark("event_time", late)
    kind = stream.schema["asset_id"].dataType.simpleString()
    found = timed.groupBy("asset_id").transformWithState(PointInTime(shape), f"asset_id {kind}, snapshots binary, labels binary", "Append", "EventTime")
    end = F.col("g") * F.lit(shape.width)
    return unpacked(found).select(
        "what",
        "asset_id",
        instant(end).alias("feature_time"),
        F.col("n").alias("telemetry_count"),
        F.col("mean").alias("value_mean"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("value_stddev"),
        F.col("low").alias("value_min"),
        F.col("high").alias("value_max"),
        ((F.col("last") - F.col("first")) / F.lit(shape.width / 3_600_000_000)).alias("value_slope"),
        F.col("spikes").alias("value_spike_count"),
        "operating_hours",
        hours(end - F.col("done")).alias("hours_since_maintenance"),
        "failures_last_90d",
        instant(F.col("failed")).alias("label_failure_time"),
    )


@contextmanager
def large_state(spark: SparkSession):
    """The state store on disk that named states and timers need; the session's own choice comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def labelled(found: DataFrame) -> DataFrame:
    """Stored snapshots with their labels: null while the horizon is open."""
    key = ["asset_id", "feature_time"]
    labels = found.where("what = 'label'").select(*key, "label_failure_time", F.col("label_failure_time").isNotNull().cast("int").alias("label_failure_within_horizon"))
    return found.where("what = 'snapshot'").drop("what", "label_failure_time").join(labels, key, "left")
