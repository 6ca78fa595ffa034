"""Normalisation in Spark expressions alone: first failing rule names the reason.

``from_json`` gives a struct of nulls, not null, for unreadable documents, so
without ``strict`` these are rejected by the first rule that misses a field;
with it, what isn't a JSON object at all is ``malformed_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..schemas import PAYLOAD

DOC = "payload"


def _rules(collection: str, strict: bool) -> list[tuple[Column, str]]:
    doc, commit = F.col(DOC), F.col(f"{DOC}.commit")
    operation, created = commit["operation"], commit["record"]["createdAt"]
    unreadable = doc.isNull()
    if strict:
        unreadable = unreadable | F.coalesce(F.expr("schema_of_variant(try_parse_json(raw_json)) NOT LIKE 'OBJECT%'"), F.lit(True))
    when = F.col("source_time_us")
    writes = operation.isin("create", "update")
    return [
        (unreadable, "malformed_json"),
        (when.isNull() | ~when.between(1, X.TIME_END_US - 1), "invalid_event_time"),
        (~doc["kind"].eqNullSafe("commit"), "unsupported_event_kind"),
        (~commit["collection"].eqNullSafe(collection), "unexpected_collection"),
        (X.blank(doc["did"]), "missing_actor_did"),
        (X.blank(commit["rkey"]), "missing_record_key"),
        (operation.isNull() | ~operation.isin(*X.EVENT_TYPES), "unsupported_operation"),
        (writes & commit["record"].isNull(), "missing_post_record"),
        (created.isNotNull() & F.try_to_timestamp(created).isNull(), "invalid_content_created_at"),
    ]


def stage(raw: DataFrame, *, collection: str = "post", strict: bool = False) -> DataFrame:
    """``raw`` with one row for each log occurrence, its parsed payload, event_id and rejection_reason."""
    own = raw.withColumn("event_id", X.physical_event_id()).dropDuplicates(["event_id"])
    # A one-element explode: the optimiser would otherwise copy the parse into every rule of the pushed-down filter.
    parsed = own.select("*", F.explode(F.array(F.from_json("raw_json", PAYLOAD))).alias(DOC))
    rules = _rules(collection, strict)
    return parsed.withColumn("rejection_reason", F.coalesce(*[F.when(fails, F.lit(reason)) for fails, reason in rules]))


def canonical(staged: DataFrame) -> DataFrame:
    doc, commit = F.col(DOC), F.col(f"{DOC}.commit")
    metadata = F.to_json(
        F.struct(
            doc["kind"].alias("kind"),
            *[commit[f].alias(n) for f, n in (("operation", "operation"), ("collection", "collection"), ("rkey", "rkey"), ("rev", "revision"), ("cid", "cid"))],
            doc["time_us"].alias("time_us"),
        )
    )
    ok = staged.where(F.col("rejection_reason").isNull())
    ok = ok.withColumn("created_us", F.unix_micros(F.try_to_timestamp(commit["record"]["createdAt"])))
    return ok.select(
        "event_id",
        "source",
        X.event_type(commit["operation"]).alias("event_type"),
        X.instant("source_time_us").alias("event_time"),
        doc["did"].alias("actor_id"),
        X.entity_uri(doc["did"], commit["collection"], commit["rkey"]).alias("entity_id"),
        F.lit("post").alias("entity_type"),
        commit["record"]["text"].alias("content_text"),
        X.languages(commit["record"]["langs"]).alias("language_codes"),
        X.instant("created_us").alias("content_created_at"),
        metadata.alias("source_metadata_json"),
        "log_topic",
        "log_partition",
        "log_offset",
        "batch_id",
        "ingested_at",
        X.now().alias("normalized_at"),
    )


def rejected(staged: DataFrame) -> DataFrame:
    bad = staged.where(F.col("rejection_reason").isNotNull())
    return bad.select("event_id", "source", "log_topic", "log_partition", "log_offset", "rejection_reason", "raw_json", X.now().alias("rejected_at"))
