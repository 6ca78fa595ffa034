"""The ``events`` test table as an event log.

Everything is derived from the table's own columns by rules that SQL engines
share: disorder, lateness, repeated commits and injected defects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X

SOURCE, TOPIC = "events", "events.v1"
#: Records in one synthetic landing batch of a log partition.
BATCH = 200

# SQL that Spark and DuckDB read alike; t is the event time in epoch microseconds, op the operation.
OPERATION = "CASE event_type WHEN 'purchase' THEN 'update' WHEN 'signup' THEN 'delete' WHEN 'error' THEN 'archive' ELSE 'create' END"
_DOCUMENT = (
    "concat('{\"did\":\"u', user_id, '\",\"kind\":\"commit\",\"time_us\":', CASE WHEN event_id % 127 = 0 THEN t + 1 ELSE t END, "
    "',\"commit\":{\"operation\":\"', op, '\",\"collection\":\"post\",\"rkey\":\"', user_id, '-', event_id % 100, '\",\"rev\":\"r', event_id % 50, "
    "'\",\"cid\":\"c\",\"record\":{\"text\":\"', event_type, '\",\"createdAt\":\"2024-01-01T00:00:00Z\",\"langs\":[\"EN\",\"en\"]}}}')"
)
RAW_JSON = f"""CASE
 WHEN event_id % 101 = 0 THEN left({_DOCUMENT}, length({_DOCUMENT}) - 10)
 WHEN event_id % 103 = 0 THEN replace({_DOCUMENT}, '"kind":"commit"', '"kind":"identity"')
 WHEN event_id % 107 = 0 THEN replace({_DOCUMENT}, '"text":"', '"text":{{"m":1}},"x_text":"')
 WHEN event_id % 109 = 0 THEN replace({_DOCUMENT}, '["EN","en"]', '"en"')
 WHEN event_id % 113 = 0 THEN replace({_DOCUMENT}, '"rev":', '"rev_x":')
 WHEN event_id % 131 = 0 THEN replace({_DOCUMENT}, '"record":{{', '"record":{{"new_field":{{"a":1}},')
 ELSE {_DOCUMENT} END"""


def raw_log(events: DataFrame) -> DataFrame:
    """``events`` as raw log records (schemas.RAW), a few of them defective."""
    timed = events.select("event_id", "user_id", "event_type", X.micros("ts").alias("t"), "ts", F.expr(OPERATION).alias("op"))
    offset = F.col("event_id").bitwiseXOR(F.lit(7))
    part = (F.col("user_id") % 3).cast("int")
    ingested = F.when(F.col("event_id") % 97 != 0, F.expr("timestampadd(SECOND, (event_id * 7919) % 1500 - 400, ts)"))
    batch = F.format_string("events_p%03d_b%06d", part, F.floor(offset / BATCH).cast("long"))
    return timed.select(
        F.lit(SOURCE).alias("source"),
        F.lit(TOPIC).alias("log_topic"),
        part.alias("log_partition"),
        offset.alias("log_offset"),
        F.concat(F.lit("at://u"), "user_id", F.lit("/post/"), "user_id", F.lit("-"), F.col("event_id") % 100).alias("log_key"),
        F.col("t").alias("source_time_us"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("landed_at"),
        F.expr(RAW_JSON).alias("raw_json"),
        batch.alias("batch_id"),
        F.concat(F.lit("ready/"), batch, F.lit("/events.jsonl")).alias("landing_path"),
        ingested.alias("ingested_at"),
    )


def simple_events(events: DataFrame) -> DataFrame:
    """Canonical-like events without JSON: archive operations out, repeats of (user, k, operation) out."""
    timed = events.select("event_id", "user_id", "ts", F.expr(OPERATION).alias("op"), F.get_json_object("props", "$.k").alias("k")).where("op <> 'archive'")
    logical = F.sha2(F.concat_ws("|", F.lit(SOURCE), F.col("user_id").cast("string"), "k", "op"), 256)
    return timed.select(
        logical.alias("event_id"),
        F.lit(SOURCE).alias("source"),
        X.event_type(F.col("op")).alias("event_type"),
        F.lit("post").alias("entity_type"),
        F.col("ts").alias("event_time"),
        F.lit(TOPIC).alias("log_topic"),
        (F.col("user_id") % 3).cast("int").alias("log_partition"),
        F.col("event_id").bitwiseXOR(F.lit(7)).alias("log_offset"),
        F.when(F.col("event_id") % 97 != 0, F.expr("timestampadd(SECOND, (event_id * 7919) % 1500 - 400, ts)")).alias("ingested_at"),
    )


def first_occurrences(simple: DataFrame) -> DataFrame:
    """One row for each logical event: the occurrence that comes first in the log."""
    columns = [c for c in simple.columns if c != "event_id"]
    best = simple.groupBy("event_id").agg(F.min_by(F.struct(*columns), F.struct("log_topic", "log_partition", "log_offset")).alias("e"))
    return best.select("event_id", "e.*")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")
