"""Extension: streams. New postings are matched batch by batch against a promoted index,
and event streams are counted in watermarked windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """window start, event_type, n and total of a stream (or table) of (ts, event_type,
    value); rows later than the watermark are dropped by a stream."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    grouped = rows.groupBy(F.window("ts", width).alias("w"), "event_type")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def for_each_new(postings: DataFrame, match: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Writes match(batch) of each micro-batch to path/batch=<epoch>: a batch that is run
    again replaces its own folder, so each posting is matched once."""

    def run(batch: DataFrame, epoch: int) -> None:
        match(batch).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return postings.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(run).start()
