"""Hourly sales from a stream of events."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from tillwise.functions.columns import gbp, pence
from tillwise.functions.scale import scratch_path

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def hourly_sales(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Purchases and revenue per hour. Repeated events are dropped within the watermark, later ones are late.

    State is bounded: ids are forgotten after `delay`, and hours closed by the watermark are removed.
    """
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return (
        stamped.filter(F.col("event_type") == "purchase")
        .dropDuplicatesWithinWatermark(["event_id"])
        .groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(pence("value")).alias("revenue_pence"))
    )


def run_stream(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> int:
    """Process what has arrived, batch by batch; returns the number of rows that came too late to be counted."""
    name, late, ended = f"tillwise-{uuid.uuid4().hex}", {}, threading.Event()
    runs: set[str] = set()

    class Late(StreamingQueryListener):
        """Counts by batch; a query's own list of progress forgets all but the last batches."""

        def onQueryStarted(self, event):
            if event.name == name:
                runs.add(str(event.runId))

        def onQueryProgress(self, event):
            if event.progress.name == name:
                late[event.progress.batchId] = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            if str(event.runId) in runs:
                ended.set()

    listener, streams = Late(), stream.sparkSession.streams
    streams.addListener(listener)
    try:
        query = (
            stream.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        # Events come in order: once the end is reported, all progress has been.
        if not ended.wait(120):
            raise RuntimeError("the stream's progress was not reported")
    finally:
        streams.removeListener(listener)
    return sum(late.values())


def run_available(stream: DataFrame, out: str, checkpoint: str) -> int:
    """Process what has arrived. Each batch writes its changed hours under its own number.

    Returns the number of rows that came too late to be counted. A batch that is run again after a failure overwrites its own folder, so hours are never doubled.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.select(F.col("w.start").alias("hour"), "orders", "revenue_pence").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return run_stream(stream, write, checkpoint, "update")


def latest_hours(spark: SparkSession, out: str) -> DataFrame:
    """The most recent state of every hour written so far."""
    rows = spark.read.schema("hour timestamp, orders bigint, revenue_pence bigint, batch bigint").parquet(out)
    newest = rows.groupBy("hour").agg(F.max_by(F.struct("orders", "revenue_pence"), "batch").alias("s"))
    return newest.select(
        F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour_start"), F.col("s.orders").alias("orders"), gbp("s.revenue_pence").alias("revenue_gbp")
    )


def stream_sales(spark: SparkSession, path: str, delay: str = "1 hour", files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over the files present and return the hourly table."""
    out, checkpoint = scratch_path(spark, "hourly-sales"), scratch_path(spark, "hourly-sales-checkpoint")
    run_available(hourly_sales(read_events(spark, path, files_per_batch), delay), out, checkpoint)
    return latest_hours(spark, out)
