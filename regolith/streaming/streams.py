"""Structured Streaming: throughput of events and incremental ingest of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def throughput(events: DataFrame, time: str = "ts", interval: str = "60 seconds", late: str = "10 minutes", group: str | None = None) -> DataFrame:
    """(window_start, group, n, per_hour): events in tumbling windows, of a stream or a table; a stream's windows close by its watermark."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    w = F.window(time, interval)
    grouped = rows.groupBy(w.alias("w"), *([group] if group else [])).agg(F.count(F.lit(1)).alias("n"))
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return grouped.select(F.col("w.start").alias("window_start"), *([group] if group else []), "n", (F.col("n") * 3600 / seconds).alias("per_hour"))


def progress(windows: DataFrame, total: int) -> DataFrame:
    """One row: done, remaining, percent, hours so far and to go, from closed windows of ``throughput``."""
    span = (F.unix_timestamp(F.max("window_start")) - F.unix_timestamp(F.min("window_start"))) / 3600
    s = windows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("done"), span.alias("hours"))
    rate = F.col("done") / F.when(F.col("hours") > 0, F.col("hours"))
    return s.select("done", (F.lit(total) - F.col("done")).alias("remaining"), (100.0 * F.col("done") / total).alias("percent"), "hours", ((F.lit(total) - F.col("done")) / rate).alias("hours_to_go"))


def incremental_ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, kind: str = "parquet") -> None:
    """Append to ``target`` what files in ``source`` no earlier call has taken, and stop."""
    stream = spark.readStream.schema(schema).format(kind).load(source)
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def not_done(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items without an output yet."""
    return items.join(done.select(key), key, "left_anti")
