"""File streams over documents derived from the conversations, and event streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.num import r6
from ..functions.when import micros
from ..session import scratch_path
from ..sources.sinks import read_store
from ..streaming import ingest, readings, snapshots as live
from .fleet import POINTS, TIMED, WINDOWS
from .registry import query
from .roles import BASE_US, sql

LINES = """x AS (SELECT conv_id, turn, role, i - 1 AS n, l[i] AS line FROM (SELECT conv_id, turn, role, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM conversations)),
    d AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS record_id, CAST(conv_id AS VARCHAR) AS user_id, role, turn, n, CASE WHEN length(line) > 0 THEN CAST(length(line) AS INTEGER) END AS v FROM x)"""
SECONDS = "CAST(turn * 300 + n AS BIGINT)"


def documents(t, fetched_at: str, shift: int, only_role: str | None = None):
    """A fetch of the feed: each text is a document and each of its lines a record.

    Lines without text have no value. ``shift`` tells the values of one fetch from another's.
    """
    rows = t.conversations if only_role is None else t.conversations.where(F.col("role") == only_role)
    numbered = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"), i.cast("string")).alias("recordId"),
            F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("turn") * 300 + i), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("systemTime"),
            F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("turn") * 300 + i - 18_000), "yyyy-MM-dd'T'HH:mm:ss'-05:00'").alias("displayTime"),
            F.when(F.length(line) > 0, F.length(line) + shift).alias("value"),
            F.col("role").alias("trend"),
            F.lit(None).cast("double").alias("trendRate"),
            F.lit("mg/dL").alias("unit"),
        ),
    )
    return rows.select(F.col("conv_id").cast("string").alias("userId"), F.lit(fetched_at).alias("fetchedAt"), numbered.alias("records"))


class Feed:
    """A landing folder, store and checkpoint of its own for one run."""

    def __init__(self, t, label):
        self.t, self.base = t, scratch_path(t.spark, label)
        self.landing, self.store, self.checkpoint = (f"{self.base}/{x}" for x in ("landing", "store", "checkpoint"))

    def drop(self, fetch: str, *args):
        documents(self.t, fetch, *args).write.mode("append").json(f"{self.landing}/{fetch[:10]}")

    def take(self):
        # one document per line: file counts then follow the data volume, not the document count
        readings.ingest(self.t.spark, f"{self.landing}/*", self.store, self.checkpoint, "*.json", multi_line=False)
        return self.rows()

    def rows(self):
        schema = readings.flatten(documents(self.t, "", 0).select("userId", "fetchedAt", F.from_json(F.to_json("records"), readings.DOCUMENT.split("records ", 1)[1]).alias("records")))
        return read_store(self.t.spark, self.store, schema.select(*readings.COLUMNS).schema)


FIRST, SECOND = "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z"


def ntz(c):
    return F.col(c).cast("timestamp_ntz").alias(c)


@query("a04_json_file_stream", f"WITH {LINES} SELECT record_id, user_id, v AS glucose_mgdl FROM d WHERE v IS NOT NULL")
def a04(t):
    feed = Feed(t, "a04")
    feed.drop(FIRST, 0)
    return feed.take().select("record_id", "user_id", "glucose_mgdl")


@query("h01_bounded_catch_up", f"WITH {LINES} SELECT user_id, count(*) AS readings, min(v) AS lowest, max(v) AS highest FROM d WHERE v IS NOT NULL GROUP BY 1")
def h01(t):
    feed = Feed(t, "h01")
    feed.drop(FIRST, 0)
    return feed.take().groupBy("user_id").agg(F.count(F.lit(1)).alias("readings"), F.min("glucose_mgdl").alias("lowest"), F.max("glucose_mgdl").alias("highest"))


@query("h02_second_run_adds_nothing", f"WITH {LINES} SELECT count(v) AS readings, count(DISTINCT record_id) FILTER (WHERE v IS NOT NULL) AS distinct_ids FROM d")
def h02(t):
    """The checkpoint remembers the files; running again changes nothing."""
    feed = Feed(t, "h02")
    feed.drop(FIRST, 0)
    feed.take()
    return feed.take().agg(F.count(F.lit(1)).alias("readings"), F.count_distinct("record_id").alias("distinct_ids"))


MERGED = f"WITH {LINES} SELECT record_id, CASE WHEN role = 'user' THEN v ELSE v + 1000 END AS glucose_mgdl FROM d WHERE v IS NOT NULL"


@query("h03_insert_only_merge", MERGED)
def h03(t):
    """The first fetch holds the user's lines; the second repeats them with other values and adds the rest.

    Stored records are never updated, so the user's lines keep the values of the first fetch.
    """
    feed = Feed(t, "h03")
    feed.drop(FIRST, 0, "user")
    feed.take()
    feed.drop(SECOND, 1000)
    return feed.take().select("record_id", "glucose_mgdl")


@query("h03_second_feed_and_new_checkpoint", f"WITH {LINES} SELECT record_id, v AS glucose_mgdl FROM d WHERE v IS NOT NULL")
def h03b(t):
    """Two landing folders feed one store, and the first is read again with a new checkpoint: nothing is lost or changed."""
    feed, other = Feed(t, "h03b"), Feed(t, "h03b-other")
    other.store = feed.store
    feed.drop(FIRST, 0, "user")
    feed.take()
    other.drop(FIRST, 0)
    other.take()
    feed.drop(SECOND, 1000)
    feed.checkpoint += "-new"
    return feed.take().select("record_id", "glucose_mgdl")


@query("a09_stream_merge_newest_in_batch", f"WITH {LINES} SELECT record_id, v + 1000 AS glucose_mgdl FROM d WHERE v IS NOT NULL")
def a09(t):
    """Two fetches in one batch: the newer one wins."""
    feed = Feed(t, "a09")
    feed.drop(FIRST, 0)
    feed.drop(SECOND, 1000)
    return feed.take().select("record_id", "glucose_mgdl")


@query("h04_utc_and_local_time", f"WITH {LINES} SELECT record_id, TIMESTAMP '2024-01-01' + to_seconds({SECONDS}) AS system_time, TIMESTAMP '2024-01-01' + to_seconds({SECONDS} - 18000) AS display_time FROM d WHERE v IS NOT NULL")
def h04(t):
    feed = Feed(t, "h04")
    feed.drop(FIRST, 0)
    return feed.take().select("record_id", ntz("system_time"), "display_time")


@query("k30_readings_summary", f"WITH {LINES} SELECT count(*) AS readings, min(TIMESTAMP '2024-01-01' + to_seconds({SECONDS})) AS first_reading, max(TIMESTAMP '2024-01-01' + to_seconds({SECONDS})) AS last_reading FROM d WHERE v IS NOT NULL")
def k30(t):
    feed = Feed(t, "k30")
    feed.drop(FIRST, 0)
    return readings.summary(feed.take()).select("readings", ntz("first_reading"), ntz("last_reading"))


def event_stream(t, folder=None, **limit):
    # as a glob, the path may be one file or a folder of parts
    path = folder or f"{t.folder}/events.parque[t]"
    stream = t.spark.readStream.schema(t.events.schema).options(**(limit or {"maxBytesPerTrigger": ingest.BATCH_BYTES})).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("h05_late_dedupe", "SELECT event_id, user_id, ts, event_type, value FROM events")
def h05(t):
    """Fetches that overlap, taken one file at a time and the newest part of the feed first: each event is kept once, late ones too."""
    base = scratch_path(t.spark, "h05")
    late = t.events.where("event_id % 3 <> 0")
    t.events.where("event_id % 3 = 0").write.parquet(f"{base}/in/first")
    ingest.keep_first(event_stream(t, f"{base}/in/*"), f"{base}/out", f"{base}/checkpoint", ["event_id"])
    late.write.parquet(f"{base}/in/late")
    t.events.where("event_type = 'error'").write.parquet(f"{base}/in/again")
    ingest.keep_first(event_stream(t, f"{base}/in/*", maxFilesPerTrigger=1), f"{base}/out", f"{base}/checkpoint", ["event_id"])
    out = read_store(t.spark, f"{base}/out", event_stream(t).schema)
    return out.select("event_id", "user_id", ntz("ts"), "event_type", "value")


@query("h06_streaming_windows", """SELECT user_id, time_bucket(INTERVAL '24 hours', ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n, round(avg(value), 6) AS mean_value, max(value) AS max_value FROM events WHERE event_type <> 'error' GROUP BY 1, 2
    HAVING time_bucket(INTERVAL '24 hours', ts, TIMESTAMP '1970-01-01') + INTERVAL 24 HOURS <= (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 6 HOURS""".replace("HAVING time_bucket(INTERVAL '24 hours', ts, TIMESTAMP '1970-01-01') +", "HAVING window_start +"))
def h06(t):
    """Windows the watermark has closed, open ones are left to the next run; the batch features of the same windows are equal."""
    base = scratch_path(t.spark, "h06")
    aggs = {"n": F.count(F.lit(1)), "mean_value": F.avg("value"), "max_value": F.max("value")}
    out = ingest.windowed_features(event_stream(t).where("event_type <> 'error'"), ["user_id"], "ts", aggs)
    ingest.append_table(out, f"{base}/out", f"{base}/checkpoint")
    done = t.spark.read.parquet(f"{base}/out")
    return done.select("user_id", ntz("window_start"), "n", r6("mean_value").alias("mean_value"), "max_value")


@query("h07_append_growth", "SELECT event_type, count(*) AS n, min(event_id) AS lowest, max(event_id) AS highest FROM events GROUP BY 1")
def h07(t):
    base = scratch_path(t.spark, "h07")
    ingest.append_table(event_stream(t), f"{base}/out", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("lowest"), F.max("event_id").alias("highest"))


LIVE = "value_mean value_stddev value_min value_max value_slope operating_hours hours_since_maintenance".split()
LIVE_SQL = sql(
    "telemetry failures meters maintenance",
    """SELECT asset_id, feature_time, telemetry_count, round(temperature_mean, 6) + 0 AS value_mean, round(temperature_stddev, 6) + 0 AS value_stddev, round(temperature_min, 6) + 0 AS value_min,
    round(temperature_max, 6) + 0 AS value_max, round(temperature_slope, 6) + 0 AS value_slope, temperature_spike_count AS value_spike_count, round(operating_hours, 6) + 0 AS operating_hours,
    round(hours_since_maintenance, 6) + 0 AS hours_since_maintenance, failures_last_90d, CASE WHEN feature_time + INTERVAL 168 HOURS <= top THEN label_failure_time END AS label_failure_time,
    CASE WHEN feature_time + INTERVAL 168 HOURS <= top THEN CAST(label_failure_time IS NOT NULL AS INTEGER) END AS label_failure_within_horizon
    FROM p, (SELECT max(ts) - INTERVAL 6 HOURS AS top FROM events) WHERE feature_time <= top""",
    WINDOWS, POINTS, TIMED,
)


def fleet_rows(events):
    """Rows of all sources of a snapshot, told apart by kind."""
    kind = F.create_map(*[F.lit(x) for x in ("error", live.FAILURE, "signup", live.METER, "purchase", live.UPKEEP)])
    rows = events.select(F.col("user_id").alias("asset_id"), F.col("ts").alias("event_time"), F.col("event_id").alias("id"), "value", "event_type")
    hours = (micros("event_time") - F.lit(BASE_US)) / F.lit(3_600_000_000.0) + F.col("value")
    # every row but a failure is telemetry, and those that the map names are something else besides
    kinds = F.when(F.col("event_type") == "error", F.array(F.lit(live.FAILURE))).otherwise(F.array_compact(F.array(F.lit(live.TELEMETRY), kind[F.col("event_type")])))
    rows = rows.select("asset_id", "event_time", "id", "value", hours.alias("hours"), F.explode(kinds).alias("kind"))
    return rows.select("asset_id", "event_time", "kind", "id", F.when(F.col("kind") == live.METER, F.col("hours")).otherwise(F.col("value")).alias("value"))


@query("h06_point_in_time_stream", LIVE_SQL)
def h06b(t):
    """Features and labels from a drained stream: those of the batch for all windows and horizons that the watermark has passed."""
    base = scratch_path(t.spark, "h06b")
    with live.large_state(t.spark):
        ingest.append_table(live.point_in_time(fleet_rows(event_stream(t)), live.Shape.of()), f"{base}/out", f"{base}/checkpoint")
    found = live.labelled(t.spark.read.parquet(f"{base}/out"))
    return found.withColumns({c: r6(c) for c in LIVE})
