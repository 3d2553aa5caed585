"""Streams over landed files. Every run is `availableNow`: it drains what is there and stops, and the
checkpoint carries positions and state to the next run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.changes import last_change
from tidemark.sinks.versioned import VersionedTable


def topic(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A landed topic as a stream; the path may be a folder or a glob."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drain(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Run to the end of the available input into a Parquet folder (exactly-once file sink)."""
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_into(stream: DataFrame, write, checkpoint: str, mode: str = "append") -> None:
    """Run to the end of the available input, handing each micro-batch to `write(batch, batch_id)`."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_into(table: VersionedTable, order: list[str], writer: str, ordered: bool = True):
    """Batch writer: at-least-once delivery becomes exactly-once by key and batch number.

    An older row in a later batch does not replace a newer one. A query's own state only moves on, so its updates
    need no `ordered`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, order, batch=(writer, batch_id), ordered=ordered)

    return write


def apply_changes_into(table: VersionedTable, order: list[str], writer: str, op: str = "op"):
    """Batch writer for a change log: last operation per key, deletes included, in whatever order batches arrive."""

    def write(batch: DataFrame, batch_id: int) -> None:
        final = last_change(batch, table.keys, order, op).withColumn("_gone", F.col(op) == "D").drop(op)
        table.merge(final, order, deleted="_gone", batch=(writer, batch_id), ordered=True)

    return write


def first_events(stream: DataFrame, key: list[str], ts: str, delay: str) -> DataFrame:
    """First event per id; state older than the watermark is dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


def tumbling_counts(stream: DataFrame, ts: str, width: str, delay: str, keys: list[str] = ()) -> DataFrame:
    """Windowed counts that accept data up to `delay` late."""
    counted = stream.withWatermark(ts, delay).groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), *keys, "n")


def newer_than(stream: DataFrame, ts: str, last_sync: str) -> DataFrame:
    """Events at or before the last sync are dropped ahead of any state."""
    return stream.filter(F.col(ts) > F.lit(last_sync).cast("timestamp"))


def key_cursors(stream: DataFrame, key: str, ts: str) -> DataFrame:
    """Latest timestamp per key, kept as aggregation state between runs (update mode)."""
    return stream.groupBy(key).agg(F.max(ts).alias("cursor"), F.count(F.lit(1)).alias("n"))


def late_rows(batch: DataFrame, ts: str, arrival: str, delay: str) -> DataFrame:
    """Rows a watermark would drop: older than the newest event of earlier arrivals by the delay.

    `arrival` names the micro-batch of each row; the running maximum is over batches, not rows.
    """
    from pyspark.sql import Window

    per_batch = batch.groupBy(arrival).agg(F.max(ts).alias("_top"))
    earlier = Window.orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    marks = per_batch.select(arrival, F.max("_top").over(earlier).alias("_seen"))
    joined = batch.join(marks, arrival)
    return joined.filter(F.col(ts) < F.col("_seen") - F.expr(f"INTERVAL {delay}")).drop("_seen")


def decoded(stream: DataFrame, payload: Column) -> DataFrame:
    """Message bytes to JSON, raw text or base64 columns."""
    from tidemark.functions.text import decode_payload

    return stream.withColumns(decode_payload(payload))
