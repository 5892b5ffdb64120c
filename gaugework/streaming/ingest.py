"""File streams into insert-only stores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.sinks import merge_insert_only


BATCH_BYTES = 64 << 30  # files that one micro-batch takes; at least one


def json_file_stream(spark: SparkSession, path: str, glob: str, schema: str, multi_line: bool = True, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """JSON documents with a declared schema, each file taken once: one document per file, or one per line."""
    reader = spark.readStream.format("json").option("multiLine", multi_line).option("pathGlobFilter", glob).option("maxBytesPerTrigger", batch_bytes)
    return reader.schema(schema).load(path)


def catch_up(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything that has arrived, then stop; progress stays in ``checkpoint``."""
    query = (
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def stream_run(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint; a new checkpoint has another one."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def insert_only_sink(
    store: str, checkpoint: str, keys: Sequence[str], newest_by: Sequence[str], shape: Callable[[DataFrame], DataFrame], columns: Sequence[str] | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: shape the batch, keep the newest per key, insert unknown keys.

    The part is named after the checkpoint's stream and the batch id: a batch that is replayed after a
    failure rewrites its own part, and another feed or a new checkpoint adds parts of its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_insert_only(store, shape(batch), keys, stream_run(batch.sparkSession, checkpoint), batch_id, newest_by, columns)

    return write


def append_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream to parquet until it is drained, in the micro-batches that its source is limited to."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def windowed_features(stream: DataFrame, keys: Sequence[str], ts: str, aggs: dict, width: str = "24 hours", late: str = "6 hours") -> DataFrame:
    """Tumbling aggregates of a stream; a window is emitted once the watermark passes its end.

    Windows that are still open when the input ends are not emitted; the next run goes on with them.
    """
    w = F.window(ts, width)
    return (
        stream.withWatermark(ts, late)
        .groupBy(*keys, w.alias("w"))
        .agg(*[c.alias(n) for n, c in aggs.items()])
        .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggs)
    )


def keep_first(stream: DataFrame, store: str, checkpoint: str, keys: Sequence[str]) -> None:
    """Store each key once, however late it or its repeats arrive: the store itself is what has been seen.

    A watermark would forget, and would drop rows that come later than it allows.
    """
    catch_up(stream, insert_only_sink(store, checkpoint, keys, (), lambda batch: batch), checkpoint)
