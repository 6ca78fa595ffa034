"""The analysts' queries.  Every top-k has a total order, so its result is one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import checks

LOG = ["log_topic", "log_partition", "log_offset"]


# Raw log.


def raw_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("total_events"))


def raw_recent(raw: DataFrame, k: int = 20) -> DataFrame:
    top = raw.orderBy(F.desc("source_time_us"), *LOG).limit(k)
    return top.select("log_partition", "log_offset", "log_key", X.instant("source_time_us").alias("source_time"), "raw_json")


def raw_text(raw: DataFrame, k: int = 30) -> DataFrame:
    text = F.get_json_object("raw_json", "$.commit.record.text")
    top = raw.withColumn("post_text", text).where("post_text IS NOT NULL").orderBy(F.desc("source_time_us"), *LOG).limit(k)
    return top.select("log_key", X.instant("source_time_us").alias("source_time"), "post_text")


def raw_by_partition(raw: DataFrame) -> DataFrame:
    stats = [F.count(F.lit(1)).alias("event_count"), F.min("log_offset").alias("first_offset"), F.max("log_offset").alias("last_offset")]
    return raw.groupBy("log_partition").agg(*stats).orderBy("log_partition")


def batch_log(batches: DataFrame, k: int = 20) -> DataFrame:
    return batches.orderBy(F.desc_nulls_last("processed_at"), "batch_id").limit(k).select("batch_id", "record_count", "processed_at", "landing_path")


def raw_duplicates(raw: DataFrame) -> DataFrame:
    return checks.repeated(raw, *LOG)


def raw_daily(raw: DataFrame) -> DataFrame:
    day = X.instant("source_time_us").cast("date").alias("event_date")
    return raw.groupBy(day).agg(F.count(F.lit(1)).alias("event_count")).orderBy("event_date")


# Canonical events, native or by contract.


def by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("source", "event_type").agg(F.count(F.lit(1)).alias("event_count")).orderBy("source", "event_type")


def latest(events: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    return events.orderBy(F.desc("event_time"), *LOG).limit(k).select(*columns)


def language_counts(events: DataFrame) -> DataFrame:
    codes = events.select(F.explode("language_codes").alias("language_code"))
    return codes.groupBy("language_code").agg(F.count(F.lit(1)).alias("event_count")).orderBy(F.desc("event_count"), "language_code")


def reasons(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("rejected_count")).orderBy(F.desc("rejected_count"), "rejection_reason")


def duplicate_ids(events: DataFrame) -> DataFrame:
    return checks.repeated(events, "event_id")


def layer_counts(raw: DataFrame, canonical: DataFrame, rejected: DataFrame, source: str) -> DataFrame:
    own = {"raw_events": raw, "canonical_events": canonical, "rejected_events": rejected}
    return checks.counts(**{name: t.where(F.col("source") == source) for name, t in own.items()})


def metadata(events: DataFrame, k: int = 20) -> DataFrame:
    of = lambda path: F.get_json_object("source_metadata_json", path)
    return events.orderBy("event_id", *LOG).limit(k).select("event_id", of("$.operation").alias("original_operation"), of("$.cid").alias("record_cid"))


# Contract outputs.


def invalid_samples(quarantine: DataFrame, k: int = 20) -> DataFrame:
    return quarantine.orderBy(F.desc("rejected_at"), *LOG).limit(k).select("log_partition", "log_offset", "rejection_reason", "raw_json")


def repeated_commits(repeats: DataFrame, k: int = 20) -> DataFrame:
    return repeats.orderBy(F.desc("log_offset"), "log_topic", "log_partition").limit(k).select("event_id", "log_partition", "log_offset", "duplicate_reason")


def observed_shapes(shapes: DataFrame) -> DataFrame:
    return shapes.orderBy(F.desc("first_seen_at"), "shape_fingerprint").select("schema_version", "shape_fingerprint", "unknown_fields_json", "sample_rejection_reason", "occurrence_id")


def unknown_fields(events: DataFrame, k: int = 20) -> DataFrame:
    strange = events.where(F.get_json_object("source_metadata_json", "$.unknown_fields") != "[]")
    return strange.orderBy("event_id").limit(k).select("event_id", "schema_version", "shape_fingerprint", "content_text", "source_metadata_json")


def payload_conflicts(repeats: DataFrame, events: DataFrame) -> DataFrame:
    chosen = events.select("event_id", F.col("payload_sha256").alias("chosen_payload"))
    both = repeats.join(chosen, "event_id").where(F.col("payload_sha256") != F.col("chosen_payload"))
    return both.select("event_id", "chosen_payload", F.col("payload_sha256").alias("duplicate_payload"), "log_partition", "log_offset")


# Windows.


def latest_windows(windows: DataFrame, k: int = 50) -> DataFrame:
    shown = ["window_start", "window_end", "post_count", "late_post_count", "very_late_post_count", "out_of_order_post_count", "future_dated_post_count", "unknown_ingestion_time_count"]
    return windows.orderBy(F.desc("window_start"), "source").limit(k).select(*shown)


def window_reconciliation(events: DataFrame, windows: DataFrame, source: str) -> DataFrame:
    posts = events.where((F.col("source") == source) & (F.col("event_type") == "content_created") & (F.col("entity_type") == "post"))
    left = posts.agg(F.count(F.lit(1)).alias("canonical_post_creates"))
    right = windows.where(F.col("source") == source).agg(F.coalesce(F.sum("post_count"), F.lit(0)).alias("window_post_creates"))
    return left.crossJoin(right)  # one row each


def lateness_totals(windows: DataFrame) -> DataFrame:
    names = {
        "late_post_count": "post_arrivals_after_window_end",
        "very_late_post_count": "more_than_10m_after_event_time",
        "out_of_order_post_count": "out_of_order_in_log_partition",
        "future_dated_post_count": "events_more_than_5m_ahead_of_ingestion",
        "unknown_ingestion_time_count": "unknown_ingestion_time",
    }
    return windows.agg(*[F.sum(c).alias(n) for c, n in names.items()])


def window_lookup(windows: DataFrame, start: str) -> DataFrame:
    return windows.where(F.col("window_start") == F.lit(start).cast("timestamp_ntz"))


def duplicate_windows(windows: DataFrame) -> DataFrame:
    return checks.repeated(windows, "source", "window_start", "window_end")
