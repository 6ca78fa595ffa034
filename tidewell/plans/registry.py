"""Every query of the engine over the test tables, and the SQL that must agree with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import checks, merge, native, reliable, windows
from ..schemas import MEASURES, WINDOW_KEY
from ..sources import eventlog
from . import catalog, jobs, landed

SOURCE = eventlog.SOURCE


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return eventlog.raw_log(eventlog.read_events(spark, d))


def _simple(spark: SparkSession, d: str) -> DataFrame:
    return eventlog.first_occurrences(eventlog.simple_events(eventlog.read_events(spark, d)))


def post_windows(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: logical events once each, then event-time windows with arrival observations."""
    return windows.post_windows(_simple(spark, d), SOURCE, checked=False).drop("aggregate_updated_at")


def _windows(spark, d):
    return windows.post_windows(_simple(spark, d), SOURCE, checked=False)


def _staged(spark, d):
    return native.stage(_raw(spark, d))


def _native(spark, d):
    return native.canonical(_staged(spark, d))


def _contract(spark, d) -> reliable.Outputs:
    return reliable.outputs(reliable.judged(reliable.occurrences(_raw(spark, d), SOURCE)))


def _batches(spark, d):
    """The ingestion log that the synthetic batches would leave."""
    return _raw(spark, d).groupBy("batch_id", "landing_path").agg(F.count(F.lit(1)).alias("record_count"), F.max("ingested_at").alias("processed_at"))


def _said(languages: str = "language_codes") -> F.Column:
    return F.concat_ws(",", languages).alias("language_codes")


def _native_rows(spark, d):
    return _native(spark, d).drop("normalized_at").withColumn("language_codes", _said())


def _contract_rows(spark, d):
    return _contract(spark, d).canonical.drop("normalized_at").withColumn("language_codes", _said())


def _reconcile(spark, d):
    """Where every occurrence went, counted in one pass over the judged events."""
    staged = reliable.judged(reliable.occurrences(_raw(spark, d), SOURCE))
    return checks.reconcile_placed(_raw(spark, d), reliable.placed(staged))


def _conflicts(spark, d):
    # Two products of the same verdicts: the events are judged once.
    staged = jobs.settled(spark, reliable.judged(reliable.occurrences(_raw(spark, d), SOURCE)))
    out = reliable.outputs(staged)
    return catalog.payload_conflicts(out.repeats, out.canonical)


def _target(rows: DataFrame) -> DataFrame:
    """Canonical events as an earlier run left them: those of even log offsets."""
    return rows.where("log_offset % 2 = 0").withColumn("content_text", F.lit("old"))


def _merge_one_key(spark, d):
    columns = ["event_id", "log_partition", "log_offset", "content_text"]
    rows = _contract_rows(spark, d)
    return merge.insert_only(_target(rows).select(*columns), rows.select(*columns), ["event_id"])


def _merge_three_keys(spark, d):
    raw = _raw(spark, d).select(*catalog.LOG, "batch_id")
    target = raw.where("log_offset % 3 <> 0").withColumn("batch_id", F.lit("earlier"))
    return merge.insert_only(target, raw, catalog.LOG)


def _stale(table: DataFrame) -> DataFrame:
    """Windows as an earlier run left them: one in three differs, some are gone, some are superfluous."""
    m = F.pmod((X.micros("window_start") / 300_000_000).cast("long"), F.lit(7))
    later = lambda c: F.expr(f"{c} + interval '100' day").alias(c)
    own = F.when(m % 3 == 0, F.col("post_count") + 1).otherwise(F.col("post_count")).alias("post_count")
    rest = [c for c in table.columns if c not in ("source", "window_start", "window_end", "post_count")]
    row = lambda source, start, end, count: F.struct(source.alias("source"), start, end, count, *rest)
    here, start, end, count = F.col("source"), F.col("window_start"), F.col("window_end"), F.col("post_count")
    versions = F.array_compact(
        F.array(
            F.when(m != 0, row(here, start, end, own)),
            F.when(m == 1, row(here, later("window_start"), later("window_end"), count)),
            F.when(m == 2, row(F.lit("other"), start, end, count)),
        )
    )
    old = F.expr("timestamp_ntz'2020-01-01 00:00:00'")
    return table.select(F.explode(versions).alias("v")).select("v.*").select(*table.columns).withColumn("aggregate_updated_at", old)


def _merge_snapshot(spark, d):
    new = _windows(spark, d).withColumn("aggregate_updated_at", F.expr("timestamp_ntz'2021-01-01 00:00:00'"))
    return merge.full_snapshot(_stale(new), new, SOURCE)


def _arrivals(spark, d):
    posts = windows.with_arrival(windows.created_posts(_simple(spark, d), SOURCE))
    return posts.select("event_id", "window_start", "window_end", "delay_seconds", "is_late", "is_very_late", "is_future_dated", "is_ingestion_unknown", "is_out_of_order")


def _frontier(spark, d):
    """By log partition: the latest event time seen, less the allowed ten minutes."""
    events = eventlog.read_events(spark, d).withColumn("log_partition", (F.col("user_id") % 3).cast("int"))
    return windows.frontiers(events, "log_partition", time="ts")


def _watermarked(spark, d):
    from ..streaming.watermark import windows_once

    return windows_once(spark, f"{d}/events.parquet")


def queries() -> dict:
    c = catalog
    return {
        "gold_posts_5m": post_windows,
        "gold_latest": lambda s, d: c.latest_windows(_windows(s, d)),
        "gold_reconcile": lambda s, d: c.window_reconciliation(_simple(s, d), _windows(s, d), SOURCE),
        "gold_lateness_totals": lambda s, d: c.lateness_totals(_windows(s, d)),
        "gold_window_lookup": lambda s, d: c.window_lookup(post_windows(s, d), "2024-01-04 14:35:00"),
        "gold_duplicate_keys": lambda s, d: c.duplicate_windows(_windows(s, d)),
        "bronze_count": lambda s, d: c.raw_count(_raw(s, d)),
        "bronze_recent": lambda s, d: c.raw_recent(_raw(s, d)),
        "bronze_text": lambda s, d: c.raw_text(_raw(s, d)),
        "bronze_by_partition": lambda s, d: c.raw_by_partition(_raw(s, d)),
        "bronze_batches": lambda s, d: c.batch_log(_batches(s, d)),
        "bronze_duplicates": lambda s, d: c.raw_duplicates(_raw(s, d)),
        "bronze_daily": lambda s, d: c.raw_daily(_raw(s, d)),
        "bronze_batch_stats": lambda s, d: checks.batch_stats(_raw(s, d), "batch_id"),
        "silver_native": _native_rows,
        "silver_native_rejected": lambda s, d: native.rejected(_staged(s, d)).drop("rejected_at"),
        "silver_native_reasons": lambda s, d: c.reasons(native.rejected(_staged(s, d))),
        "silver_native_strict": lambda s, d: c.reasons(native.rejected(native.stage(_raw(s, d), strict=True))),
        "silver_by_type": lambda s, d: c.by_type(_native(s, d)),
        "silver_latest": lambda s, d: c.latest(_native(s, d).withColumn("language_codes", _said()), ["event_time", "event_type", "actor_id", "entity_id", "content_text", "language_codes"]),
        "silver_languages": lambda s, d: c.language_counts(_native(s, d)),
        "silver_duplicate_ids": lambda s, d: c.duplicate_ids(_native(s, d)),
        "silver_counts": lambda s, d: c.layer_counts(_raw(s, d), _native(s, d), native.rejected(_staged(s, d)), SOURCE),
        "silver_metadata": lambda s, d: c.metadata(_native(s, d)),
        "contract_canonical": _contract_rows,
        "contract_rejected": lambda s, d: _contract(s, d).quarantine.drop("rejected_at", "shape_fingerprint"),
        "contract_duplicates": lambda s, d: _contract(s, d).repeats.drop("detected_at"),
        "contract_duplicate_ids": lambda s, d: c.duplicate_ids(_contract(s, d).canonical),
        "contract_reasons": lambda s, d: c.reasons(_contract(s, d).quarantine),
        "contract_invalid_samples": lambda s, d: c.invalid_samples(_contract(s, d).quarantine),
        "contract_repeated_commits": lambda s, d: c.repeated_commits(_contract(s, d).repeats),
        "contract_shapes": lambda s, d: c.observed_shapes(_contract(s, d).shapes),
        "contract_unknown_fields": lambda s, d: c.unknown_fields(_contract(s, d).canonical),
        "contract_latest": lambda s, d: c.latest(_contract_rows(s, d), ["event_time", "event_type", "entity_id", "content_text", "language_codes", "schema_version"]),
        "contract_reconcile": _reconcile,
        "contract_payload_conflicts": _conflicts,
        "document_languages": _document_languages,
        "merge_insert_only_1key": _merge_one_key,
        "merge_insert_only_3key": _merge_three_keys,
        "merge_full_snapshot": _merge_snapshot,
        "arrival_classification": _arrivals,
        "watermark_frontier": _frontier,
        "watermark_windows": _watermarked,
        **landed.queries(),
    }


def _document_languages(spark, d):
    """Language normalisation and explode over documents.lang with blanks and variants."""
    supplied = F.array("lang", F.upper("lang"), F.lit(""), F.concat(F.lit(" "), "lang"), F.concat(F.lit("x-"), "lang"))
    docs = spark.read.parquet(f"{d}/documents.parquet").select(X.languages(supplied).alias("language_codes"))
    return catalog.language_counts(docs)


# The same in SQL.

_LOG = f"""
WITH timed AS (
  SELECT event_id, user_id, event_type, ts, props, epoch_us(ts) AS t, {eventlog.OPERATION} AS op, xor(event_id, 7) AS log_offset,
    CAST(user_id % 3 AS INT) AS log_partition,
    CASE WHEN event_id % 97 <> 0 THEN ts + to_seconds(CAST((event_id * 7919) % 1500 - 400 AS BIGINT)) END AS ingested_at
  FROM events),
raw AS (
  SELECT *, 'events' AS source, 'events.v1' AS log_topic, {eventlog.RAW_JSON} AS raw_json,
    'events_p' || lpad(CAST(log_partition AS VARCHAR), 3, '0') || '_b' || lpad(CAST(log_offset // {eventlog.BATCH} AS VARCHAR), 6, '0') AS batch_id,
    'at://u' || user_id || '/post/' || user_id || '-' || event_id % 100 AS log_key,
    CASE WHEN event_id % 101 = 0 THEN 101 WHEN event_id % 103 = 0 THEN 103 WHEN event_id % 107 = 0 THEN 107
      WHEN event_id % 109 = 0 THEN 109 WHEN event_id % 113 = 0 THEN 113 WHEN event_id % 131 = 0 THEN 131 ELSE 0 END AS defect,
    CASE op WHEN 'create' THEN 'content_created' WHEN 'update' THEN 'content_updated' WHEN 'delete' THEN 'content_deleted' END AS kind
  FROM timed),
simple AS (
  SELECT * EXCLUDE (rank) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY log_partition, log_offset) AS rank FROM (
      SELECT sha256(concat_ws('|', 'events', CAST(user_id AS VARCHAR), props->>'$.k', op)) AS event_id, 'events' AS source,
        CASE op WHEN 'create' THEN 'content_created' WHEN 'update' THEN 'content_updated' ELSE 'content_deleted' END AS event_type,
        ts AS event_time, log_partition, log_offset, ingested_at
      FROM timed WHERE op <> 'archive'))
  WHERE rank = 1),
posts AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time, TIMESTAMP '1970-01-01') AS window_start,
    max(event_time) OVER (PARTITION BY log_partition ORDER BY log_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before,
    (epoch_us(ingested_at) - epoch_us(event_time)) / 1000000.0 AS delay
  FROM simple WHERE event_type = 'content_created'),
arrivals AS (
  SELECT *, window_start + INTERVAL 5 MINUTE AS window_end,
    CASE WHEN ingested_at >= window_start + INTERVAL 5 MINUTE THEN 1 ELSE 0 END AS is_late, CASE WHEN delay > 600 THEN 1 ELSE 0 END AS is_very_late,
    CASE WHEN delay < -300 THEN 1 ELSE 0 END AS is_future_dated, CASE WHEN ingested_at IS NULL THEN 1 ELSE 0 END AS is_ingestion_unknown,
    CASE WHEN latest_before > event_time THEN 1 ELSE 0 END AS is_out_of_order
  FROM posts),
gold AS (
  SELECT source, window_start, window_end, count(*) AS post_count, CAST(sum(is_late) AS BIGINT) AS late_post_count,
    CAST(sum(is_very_late) AS BIGINT) AS very_late_post_count, CAST(sum(is_out_of_order) AS BIGINT) AS out_of_order_post_count,
    CAST(sum(is_future_dated) AS BIGINT) AS future_dated_post_count, CAST(sum(is_ingestion_unknown) AS BIGINT) AS unknown_ingestion_time_count,
    CAST(max(greatest(0.0, coalesce(delay, 0.0))) AS DOUBLE) AS max_ingestion_delay_seconds, max(event_time) AS last_event_time, max(ingested_at) AS latest_ingested_at
  FROM arrivals GROUP BY source, window_start, window_end),
native AS (
  SELECT 'events:events.v1:' || log_partition || ':' || log_offset AS event_id, source, kind AS event_type, ts AS event_time, 'u' || user_id AS actor_id,
    log_key AS entity_id, 'post' AS entity_type, CASE WHEN defect = 107 THEN '{{"m":1}}' ELSE event_type END AS content_text,
    CASE WHEN defect = 109 THEN '' ELSE 'en' END AS language_codes, TIMESTAMP '2024-01-01 00:00:00' AS content_created_at,
    '{{"kind":"commit","operation":"' || op || '","collection":"post","rkey":"' || user_id || '-' || event_id % 100 || '"' ||
      CASE WHEN defect = 113 THEN '' ELSE ',"revision":"r' || event_id % 50 || '"' END || ',"cid":"c","time_us":' || CASE WHEN event_id % 127 = 0 THEN t + 1 ELSE t END || '}}' AS source_metadata_json,
    log_topic, log_partition, log_offset, batch_id, ingested_at, raw_json,
    CASE WHEN defect IN (101, 103) THEN 'unsupported_event_kind' WHEN op = 'archive' THEN 'unsupported_operation' END AS rejection_reason,
    CASE WHEN defect = 101 THEN 'malformed_json' WHEN defect = 103 THEN 'unsupported_event_kind' WHEN op = 'archive' THEN 'unsupported_operation' END AS strict_reason
  FROM raw),
judged AS (
  SELECT raw.*, CASE WHEN defect = 101 THEN 'malformed_json' WHEN defect = 103 THEN 'unsupported_event_kind' WHEN op = 'archive' THEN 'unsupported_operation'
      WHEN defect = 113 THEN 'missing_revision' WHEN event_id % 127 = 0 THEN 'timestamp_mismatch'
      WHEN defect = 107 AND op <> 'delete' THEN 'invalid_field_type:commit.record.text' WHEN defect = 109 AND op <> 'delete' THEN 'invalid_field_type:commit.record.langs' END AS rejection_reason,
    CASE defect WHEN 107 THEN '["$.commit.record.x_text"]' WHEN 113 THEN '["$.commit.rev_x"]' WHEN 131 THEN '["$.commit.record.new_field"]' ELSE '[]' END AS unknown_fields_json,
    sha256('{{"source":"events","log_topic":"events.v1","log_partition":' || log_partition || ',"log_offset":' || log_offset || '}}') AS occurrence_id,
    sha256(raw_json) AS payload_sha256, 'post.v1' AS schema_version,
    'events:' || sha256('["events","u' || user_id || '","post","' || user_id || '-' || event_id % 100 || '","r' || event_id % 50 || '","' || op || '"]') AS logical_id,
    CASE WHEN defect <> 101 THEN sha256('{{"$":{{"commit":"object","did":"string","kind":"string","time_us":"integer"}},"$.commit":{{"cid":"string","collection":"string","operation":"string","record":"object","rev' ||
      CASE WHEN defect = 113 THEN '_x' ELSE '' END || '":"string","rkey":"string"}},"$.commit.record":{{"createdAt":"string","langs":"' || CASE WHEN defect = 109 THEN 'string' ELSE 'array<string>' END || '",' ||
      CASE WHEN defect = 131 THEN '"new_field":"object",' ELSE '' END || '"text":"' || CASE WHEN defect = 107 THEN 'object","x_text":"string' ELSE 'string' END || '"}}}}') END AS shape_fingerprint
  FROM raw),
ranked AS (SELECT *, row_number() OVER (PARTITION BY logical_id ORDER BY log_topic, log_partition, log_offset) AS rank FROM judged WHERE rejection_reason IS NULL),
canonical AS (
  SELECT logical_id AS event_id, source, kind AS event_type, ts AS event_time, 'u' || user_id AS actor_id, log_key AS entity_id, 'post' AS entity_type,
    CASE WHEN op <> 'delete' THEN event_type END AS content_text, CASE WHEN op <> 'delete' THEN 'en' ELSE '' END AS language_codes,
    CASE WHEN op <> 'delete' THEN TIMESTAMP '2024-01-01 00:00:00' END AS content_created_at,
    '{{"cid":"c","collection":"post","kind":"commit","operation":"' || op || '","revision":"r' || event_id % 50 || '","rkey":"' || user_id || '-' || event_id % 100 || '","time_us":' || t || ',"unknown_fields":' || unknown_fields_json || '}}' AS source_metadata_json,
    log_topic, log_partition, log_offset, batch_id, ingested_at, schema_version, shape_fingerprint, occurrence_id, payload_sha256
  FROM ranked WHERE rank = 1),
repeats AS (SELECT occurrence_id, logical_id AS event_id, source, log_topic, log_partition, log_offset, payload_sha256, 'repeated_source_commit' AS duplicate_reason, batch_id FROM ranked WHERE rank > 1),
quarantine AS (SELECT occurrence_id, source, log_topic, log_partition, log_offset, rejection_reason, schema_version, unknown_fields_json, raw_json, batch_id FROM judged WHERE rejection_reason IS NOT NULL),
batches AS (SELECT batch_id, 'ready/' || batch_id || '/events.jsonl' AS landing_path, count(*) AS record_count, max(ingested_at) AS processed_at FROM raw GROUP BY batch_id)
"""


def _grouped(table: str, key: str) -> str:
    return f"SELECT {key}, count(*) AS occurrences FROM {table} GROUP BY {key} HAVING count(*) > 1"


def oracle_sql() -> dict[str, str]:
    gold = ", ".join([*WINDOW_KEY, *MEASURES])
    seventh = "CAST(epoch_us(window_start) // 300000000 AS BIGINT) % 7"
    stale = ", ".join(m if m != "post_count" else f"CASE WHEN ({seventh}) % 3 = 0 THEN post_count + 1 ELSE post_count END AS post_count" for m in MEASURES)
    measures = ", ".join(MEASURES)
    same = " AND ".join(f"o.{m} IS NOT DISTINCT FROM n.{m}" for m in MEASURES)
    pick = lambda c: f"CASE WHEN o.source IS NOT NULL AND (n.source IS NULL OR ({same})) THEN o.{c} ELSE n.{c} END AS {c}"
    body = {
        "gold_posts_5m": f"SELECT {gold} FROM gold",
        "gold_latest": "SELECT window_start, window_end, post_count, late_post_count, very_late_post_count, out_of_order_post_count, future_dated_post_count, unknown_ingestion_time_count FROM gold ORDER BY window_start DESC, source LIMIT 50",
        "gold_reconcile": "SELECT (SELECT count(*) FROM simple WHERE event_type = 'content_created') AS canonical_post_creates, (SELECT CAST(coalesce(sum(post_count), 0) AS BIGINT) FROM gold) AS window_post_creates",
        "gold_lateness_totals": "SELECT CAST(sum(late_post_count) AS BIGINT) AS post_arrivals_after_window_end, CAST(sum(very_late_post_count) AS BIGINT) AS more_than_10m_after_event_time, CAST(sum(out_of_order_post_count) AS BIGINT) AS out_of_order_in_log_partition, CAST(sum(future_dated_post_count) AS BIGINT) AS events_more_than_5m_ahead_of_ingestion, CAST(sum(unknown_ingestion_time_count) AS BIGINT) AS unknown_ingestion_time FROM gold",
        "gold_window_lookup": f"SELECT {gold} FROM gold WHERE window_start = TIMESTAMP '2024-01-04 14:35:00'",
        "gold_duplicate_keys": _grouped("gold", "source, window_start, window_end"),
        "bronze_count": "SELECT count(*) AS total_events FROM raw",
        "bronze_recent": "SELECT log_partition, log_offset, log_key, ts AS source_time, raw_json FROM raw ORDER BY t DESC, log_partition, log_offset LIMIT 20",
        "bronze_text": "SELECT log_key, ts AS source_time, CASE WHEN defect = 107 THEN '{\"m\":1}' ELSE event_type END AS post_text FROM raw WHERE defect <> 101 ORDER BY t DESC, log_partition, log_offset LIMIT 30",
        "bronze_by_partition": "SELECT log_partition, count(*) AS event_count, min(log_offset) AS first_offset, max(log_offset) AS last_offset FROM raw GROUP BY log_partition ORDER BY log_partition",
        "bronze_batches": "SELECT batch_id, record_count, processed_at, landing_path FROM batches ORDER BY processed_at DESC NULLS LAST, batch_id LIMIT 20",
        "bronze_duplicates": _grouped("raw", "log_topic, log_partition, log_offset"),
        "bronze_daily": "SELECT CAST(ts AS DATE) AS event_date, count(*) AS event_count FROM raw GROUP BY 1 ORDER BY 1",
        "bronze_batch_stats": "SELECT batch_id, count(*) AS record_count, count(DISTINCT log_offset) AS distinct_offsets, min(log_offset) AS first_offset, max(log_offset) AS last_offset, CAST(0 AS BIGINT) AS invalid_records FROM raw GROUP BY batch_id",
        "silver_native": "SELECT * EXCLUDE (raw_json, rejection_reason, strict_reason) FROM native WHERE rejection_reason IS NULL",
        "silver_native_rejected": "SELECT event_id, source, log_topic, log_partition, log_offset, rejection_reason, raw_json FROM native WHERE rejection_reason IS NOT NULL",
        "silver_native_reasons": "SELECT rejection_reason, count(*) AS rejected_count FROM native WHERE rejection_reason IS NOT NULL GROUP BY 1",
        "silver_native_strict": "SELECT strict_reason AS rejection_reason, count(*) AS rejected_count FROM native WHERE strict_reason IS NOT NULL GROUP BY 1",
        "silver_by_type": "SELECT source, event_type, count(*) AS event_count FROM native WHERE rejection_reason IS NULL GROUP BY 1, 2",
        "silver_latest": "SELECT event_time, event_type, actor_id, entity_id, content_text, language_codes FROM native WHERE rejection_reason IS NULL ORDER BY event_time DESC, log_partition, log_offset LIMIT 20",
        "silver_languages": "SELECT language_codes AS language_code, count(*) AS event_count FROM native WHERE rejection_reason IS NULL AND language_codes <> '' GROUP BY 1",
        "silver_duplicate_ids": _grouped("native", "event_id"),
        "silver_counts": "SELECT (SELECT count(*) FROM raw) AS raw_events, (SELECT count(*) FROM native WHERE rejection_reason IS NULL) AS canonical_events, (SELECT count(*) FROM native WHERE rejection_reason IS NOT NULL) AS rejected_events",
        "silver_metadata": "SELECT event_id, source_metadata_json->>'$.operation' AS original_operation, source_metadata_json->>'$.cid' AS record_cid FROM native WHERE rejection_reason IS NULL ORDER BY event_id LIMIT 20",
        "contract_canonical": "SELECT * FROM canonical",
        "contract_rejected": "SELECT * FROM quarantine",
        "contract_duplicates": "SELECT * FROM repeats",
        "contract_duplicate_ids": _grouped("canonical", "event_id"),
        "contract_reasons": "SELECT rejection_reason, count(*) AS rejected_count FROM quarantine GROUP BY 1",
        "contract_invalid_samples": "SELECT log_partition, log_offset, rejection_reason, raw_json FROM quarantine ORDER BY log_partition, log_offset LIMIT 20",
        "contract_repeated_commits": "SELECT event_id, log_partition, log_offset, duplicate_reason FROM repeats ORDER BY log_offset DESC, log_partition LIMIT 20",
        "contract_shapes": "SELECT schema_version, shape_fingerprint, unknown_fields_json, rejection_reason AS sample_rejection_reason, occurrence_id FROM (SELECT *, row_number() OVER (PARTITION BY shape_fingerprint ORDER BY log_topic, log_partition, log_offset) AS r FROM judged WHERE shape_fingerprint IS NOT NULL) WHERE r = 1",
        "contract_unknown_fields": "SELECT event_id, schema_version, shape_fingerprint, content_text, source_metadata_json FROM canonical WHERE source_metadata_json NOT LIKE '%\"unknown_fields\":[]}' ORDER BY event_id LIMIT 20",
        "contract_latest": "SELECT event_time, event_type, entity_id, content_text, language_codes, schema_version FROM canonical ORDER BY event_time DESC, log_partition, log_offset LIMIT 20",
        "contract_reconcile": "SELECT *, raw - (canonical + quarantined + duplicates) AS unaccounted FROM (SELECT (SELECT count(*) FROM raw) AS raw, (SELECT count(*) FROM canonical) AS canonical, (SELECT count(*) FROM quarantine) AS quarantined, (SELECT count(*) FROM repeats) AS duplicates)",
        "contract_payload_conflicts": "SELECT r.event_id, c.payload_sha256 AS chosen_payload, r.payload_sha256 AS duplicate_payload, r.log_partition, r.log_offset FROM repeats r JOIN canonical c USING (event_id) WHERE r.payload_sha256 <> c.payload_sha256",
        "merge_insert_only_1key": "SELECT event_id, log_partition, log_offset, CASE WHEN log_offset % 2 = 0 THEN 'old' ELSE content_text END AS content_text FROM canonical",
        "merge_insert_only_3key": "SELECT log_topic, log_partition, log_offset, CASE WHEN log_offset % 3 <> 0 THEN 'earlier' ELSE batch_id END AS batch_id FROM raw",
        "merge_full_snapshot": f"""SELECT {', '.join(pick(c) for c in [*WINDOW_KEY, *MEASURES, 'aggregate_updated_at'])} FROM (
            SELECT *, TIMESTAMP '2020-01-01' AS aggregate_updated_at FROM (
              SELECT {', '.join(WINDOW_KEY)}, {stale} FROM gold WHERE {seventh} <> 0
              UNION ALL SELECT source, window_start + INTERVAL 100 DAY, window_end + INTERVAL 100 DAY, {measures} FROM gold WHERE {seventh} = 1
              UNION ALL SELECT 'other', window_start, window_end, {measures} FROM gold WHERE {seventh} = 2)) o
          FULL JOIN (SELECT *, TIMESTAMP '2021-01-01' AS aggregate_updated_at FROM gold) n ON o.source = n.source AND o.window_start = n.window_start AND o.window_end = n.window_end
          WHERE NOT (n.source IS NULL AND o.source = 'events')""",
        "arrival_classification": "SELECT event_id, window_start, window_end, CAST(delay AS DOUBLE) AS delay_seconds, is_late, is_very_late, is_future_dated, is_ingestion_unknown, is_out_of_order FROM arrivals",
        "watermark_windows": "SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, post_count FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS post_count, max(max(ts)) OVER () AS latest "
        "FROM events WHERE event_type IN ('view', 'click') GROUP BY 1) WHERE window_start + INTERVAL 5 MINUTE <= latest - INTERVAL 10 MINUTE",
        **landed.oracle_sql(),
        "watermark_frontier": "SELECT log_partition, max(ts) - INTERVAL 10 MINUTE AS frontier FROM timed GROUP BY log_partition",
    }
    out = {name: _LOG + sql for name, sql in body.items()}
    out["document_languages"] = "SELECT language_code, count(*) AS event_count FROM (SELECT unnest([lang, 'x-' || lang]) AS language_code FROM documents) GROUP BY 1"
    return out
