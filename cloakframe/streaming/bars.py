"""Streams: bars of events, news without repeats, masked documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import scrubbed


def event_stream(spark: SparkSession, folder: str, pattern: str = "events.parquet") -> DataFrame:
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def tumbling_bars(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Bars of `value` by event type and window; the state of a window goes once the watermark has passed it.

    Rows that already have `at` (from without_repeats) keep its watermark."""
    timed = events if "at" in events.columns else events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    w = timed.groupBy(F.window("at", width), "event_type")
    out = w.agg(F.min_by("value", F.struct("at", "event_id")).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", F.struct("at", "event_id")).alias("close"), F.count("*").alias("n"))
    return out.select("event_type", F.col("window.start").alias("start"), "open", "high", "low", "close", "n")


def without_repeats(events: DataFrame, key: str = "event_id", late: str = "2 hours") -> DataFrame:
    """R17 as a stream: the first row of each key within the watermark."""
    return events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late).dropDuplicatesWithinWatermark([key])


def scrubbed_stream(docs: DataFrame) -> DataFrame:
    """T15 on a stream: stateless, so each micro-batch is independent."""
    return docs.withColumn("text", scrubbed(F.col("text")))
