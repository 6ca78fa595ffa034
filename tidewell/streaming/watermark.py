"""Event-time windows over a stream: emitted once when the watermark passes, later events dropped.

This is another product than the corrected batch windows, which drop nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..runtime import shared_root

LAG, WIDTH = "10 minutes", "5 minutes"


def windowed_counts(stream: DataFrame, *, time: str = "event_time", lag: str = LAG, width: str = WIDTH) -> DataFrame:
    """(window_start, window_end, post_count) of a stream or table with a TIMESTAMP column ``time``."""
    counted = stream.withWatermark(time, lag).groupBy(F.window(time, width).alias("w")).agg(F.count(F.lit(1)).alias("post_count"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "post_count")


def append_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Processes what is there now and appends closed windows as Parquet; again from the same checkpoint it goes on."""
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", target).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see."""
    return f"{shared_root(spark)}/{name}/{uuid.uuid4().hex}"


def windows_once(spark: SparkSession, events: str) -> DataFrame:
    """The windows that a stream over the event files has closed when it has seen them all."""
    folder = shared_folder(spark, "watermark_windows")
    schema = spark.read.parquet(events).schema
    path, name = events.rsplit("/", 1)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(path)
    posts = stream.where("event_type IN ('view', 'click')").select(F.col("ts").cast("timestamp").alias("event_time"))
    append_available(windowed_counts(posts), f"{folder}/windows", f"{folder}/checkpoint")
    out = spark.read.schema("window_start timestamp, window_end timestamp, post_count bigint").parquet(f"{folder}/windows")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"), "post_count")
