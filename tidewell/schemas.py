"""Fixed schemas; nothing is inferred.  Instants are UTC wall-clock times (TIMESTAMP_NTZ), which no session zone shifts."""

from __future__ import annotations

from pyspark.sql import types as T


_ATOMS = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "timestamp_ntz": T.TimestampNTZType()}


def _parts(spec: str) -> list[str]:
    """The spec cut at commas outside angle brackets."""
    out, depth = [""], 0
    for ch in spec:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return [x.strip() for x in out]


def _type(spec: str) -> T.DataType:
    if spec.startswith("array<"):
        return T.ArrayType(_type(spec[6:-1]))
    if spec.startswith("struct<"):
        return _struct(spec[7:-1].replace(": ", " "))
    return _ATOMS[spec]


def _struct(spec: str) -> T.StructType:
    """A schema from "name type[ not null], ..." — without a session, unlike StructType.fromDDL."""
    fields = []
    for part in _parts(spec):
        name, kind = part.split(" ", 1)
        fields.append(T.StructField(name, _type(kind.removesuffix(" not null")), not kind.endswith(" not null")))
    return T.StructType(fields)


LANDING = _struct("source string, log_topic string, log_partition int, log_offset bigint, log_key string, source_time_us bigint, landed_at string, raw_json string")

MANIFEST = _struct(
    "format_version int, batch_id string, source string, status string, created_at string, log_topic string, log_partition int, "
    "first_offset bigint, last_offset bigint, next_offset bigint, record_count bigint, data_file string, size_bytes bigint, "
    "sha256 string, offsets_sha256 string, min_source_time_us bigint, max_source_time_us bigint"
)

RAW = _struct(
    "source string, log_topic string, log_partition int, log_offset bigint, log_key string, source_time_us bigint, landed_at string, "
    "raw_json string, batch_id string, landing_path string, ingested_at timestamp_ntz"
)
BATCH_LOG = _struct("batch_id string not null, landing_path string not null, events_sha256 string not null, record_count bigint not null, processed_at timestamp_ntz")

#: The nested source document, as far as the native rules read it.
PAYLOAD = _struct(
    "did string, kind string, time_us bigint, commit struct<operation: string, collection: string, rkey: string, rev: string, cid: string, "
    "record: struct<text: string, createdAt: string, langs: array<string>>>"
)

_EVENT = (
    "event_id string, source string, event_type string, event_time timestamp_ntz, actor_id string, entity_id string, entity_type string, "
    "content_text string, language_codes array<string>, content_created_at timestamp_ntz, source_metadata_json string, log_topic string, "
    "log_partition int, log_offset bigint, batch_id string, ingested_at timestamp_ntz, normalized_at timestamp_ntz"
)
CANONICAL_NATIVE = _struct(_EVENT)
REJECTED_NATIVE = _struct("event_id string, source string, log_topic string, log_partition int, log_offset bigint, rejection_reason string, raw_json string, rejected_at timestamp_ntz")

CANONICAL = _struct(_EVENT + ", schema_version string, shape_fingerprint string, occurrence_id string, payload_sha256 string")
QUARANTINE = _struct(
    "occurrence_id string, source string, log_topic string, log_partition int, log_offset bigint, rejection_reason string, schema_version string, "
    "shape_fingerprint string, unknown_fields_json string, raw_json string, batch_id string, rejected_at timestamp_ntz"
)
REPEATS = _struct(
    "occurrence_id string, event_id string, source string, log_topic string, log_partition int, log_offset bigint, payload_sha256 string, "
    "duplicate_reason string, batch_id string, detected_at timestamp_ntz"
)
SHAPES = _struct("shape_fingerprint string, schema_version string, unknown_fields_json string, occurrence_id string, sample_rejection_reason string, first_seen_at timestamp_ntz")

MEASURES = [
    "post_count",
    "late_post_count",
    "very_late_post_count",
    "out_of_order_post_count",
    "future_dated_post_count",
    "unknown_ingestion_time_count",
    "max_ingestion_delay_seconds",
    "last_event_time",
    "latest_ingested_at",
]
WINDOW_KEY = ["source", "window_start", "window_end"]
WINDOWS = _struct(
    "source string, window_start timestamp_ntz, window_end timestamp_ntz, post_count bigint, late_post_count bigint, very_late_post_count bigint, "
    "out_of_order_post_count bigint, future_dated_post_count bigint, unknown_ingestion_time_count bigint, max_ingestion_delay_seconds double, "
    "last_event_time timestamp_ntz, latest_ingested_at timestamp_ntz, aggregate_updated_at timestamp_ntz"
)

#: What the contract says of one raw event.
VERDICT = _struct(
    "rejection_reason string, event_id string, event_type string, event_time_us bigint, actor_id string, entity_id string, entity_type string, "
    "content_text string, language_codes array<string>, content_created_at_us bigint, source_metadata_json string, schema_version string, "
    "shape_fingerprint string, unknown_fields_json string"
)

TABLES = {
    "raw_events": RAW,
    "ingested_batches": BATCH_LOG,
    "canonical_native": CANONICAL_NATIVE,
    "rejected_native": REJECTED_NATIVE,
    "canonical_events": CANONICAL,
    "quarantine": QUARANTINE,
    "duplicate_occurrences": REPEATS,
    "schema_observations": SHAPES,
    "post_windows": WINDOWS,
}
