"""Device readings: documents with a header and an array of records, into one row per record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .ingest import catch_up, insert_only_sink, json_file_stream

# Document schema, file name pattern and stored columns of the readings feed.
DOCUMENT = (
    "userId string, fetchedAt string, records array<struct<recordId: string, systemTime: string, displayTime: string, value: int, "
    "trend: string, trendRate: double, unit: string, rateUnit: string, transmitterGeneration: string, displayDevice: string, displayApp: string>>"
)
FILES = "egv_*.json"
STORED = {
    "record_id": "recordId",
    "trend": "trend",
    "trend_rate": "trendRate",
    "unit": "unit",
    "rate_unit": "rateUnit",
    "transmitter_generation": "transmitterGeneration",
    "display_device": "displayDevice",
    "display_app": "displayApp",
}


def flatten(documents: DataFrame) -> DataFrame:
    """One row per record with a value: the UTC instant and the device's own local time apart."""
    rows = documents.select(F.col("userId").alias("user_id"), F.col("fetchedAt").alias("fetched_at"), F.explode("records").alias("r"))
    return rows.where("r.value IS NOT NULL").select(
        "user_id",
        "fetched_at",
        F.to_timestamp("r.systemTime").alias("system_time"),
        F.substring("r.displayTime", 1, 19).cast("timestamp_ntz").alias("display_time"),
        F.col("r.value").alias("glucose_mgdl"),
        *[F.col(f"r.{c}").alias(n) for n, c in STORED.items()],
    )


COLUMNS = ["record_id", "user_id", "system_time", "display_time", "glucose_mgdl", *list(STORED)[1:]]


def ingest(spark: SparkSession, landing: str, store: str, checkpoint: str, glob: str = FILES, multi_line: bool = True, stamp: bool = False) -> None:
    """Take the new files of ``landing``; insert records the store does not have, newest fetch first."""

    def shape(batch: DataFrame) -> DataFrame:
        rows = flatten(batch)
        return rows.withColumn("ingested_at", F.current_timestamp()) if stamp else rows

    columns = [*COLUMNS, "ingested_at"] if stamp else COLUMNS
    sink = insert_only_sink(store, checkpoint, ["record_id"], ["fetched_at"], shape, columns)
    catch_up(json_file_stream(spark, landing, glob, DOCUMENT, multi_line), sink, checkpoint)


def summary(readings: DataFrame) -> DataFrame:
    return readings.agg(
        F.count(F.lit(1)).alias("readings"), F.min("system_time").alias("first_reading"), F.max("system_time").alias("last_reading")
    )
