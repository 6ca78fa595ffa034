"""Contract outputs: canonical events, quarantine, repeated commits and observed shapes.

Every log occurrence lands in exactly one of the first three.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.contract import Contract, with_verdict

#: Order in which occurrences of one commit or shape compete; the first wins.
LOG_ORDER = ["log_topic", "log_partition", "log_offset"]
RAW_COLUMNS = ["source", "log_topic", "log_partition", "log_offset", "source_time_us", "raw_json", "batch_id", "ingested_at"]


class Outputs(NamedTuple):
    canonical: DataFrame
    quarantine: DataFrame
    repeats: DataFrame
    shapes: DataFrame


def occurrences(raw: DataFrame, source: str = "events") -> DataFrame:
    """One row for each log occurrence of the source, with its identity and payload hash."""
    own = raw.where(F.col("source") == source).select(*RAW_COLUMNS)
    named = own.withColumns({"occurrence_id": X.occurrence_id(), "payload_sha256": F.sha2("raw_json", 256)})
    return named.dropDuplicates(["occurrence_id"])


def judged(found: DataFrame, contract: Contract = Contract()) -> DataFrame:
    return with_verdict(found, contract)


def outputs(staged: DataFrame) -> Outputs:
    """The four products of judged occurrences.

    ``staged`` is read by each of them; callers that write all four should
    materialise it first, so the contract runs once.
    """
    verdict = F.col("verdict")
    good = staged.where(verdict["rejection_reason"].isNull())
    rank = F.row_number().over(Window.partitionBy(verdict["event_id"]).orderBy(*LOG_ORDER))
    ranked = good.withColumn("rank", rank)
    canonical = ranked.where("rank = 1").select(
        verdict["event_id"].alias("event_id"),
        "source",
        verdict["event_type"].alias("event_type"),
        X.instant("verdict.event_time_us").alias("event_time"),
        *[verdict[c].alias(c) for c in ("actor_id", "entity_id", "entity_type", "content_text", "language_codes")],
        X.instant("verdict.content_created_at_us").alias("content_created_at"),
        verdict["source_metadata_json"].alias("source_metadata_json"),
        "log_topic",
        "log_partition",
        "log_offset",
        "batch_id",
        "ingested_at",
        X.now().alias("normalized_at"),
        *[verdict[c].alias(c) for c in ("schema_version", "shape_fingerprint")],
        "occurrence_id",
        "payload_sha256",
    )
    quarantine = staged.where(verdict["rejection_reason"].isNotNull()).select(
        "occurrence_id",
        "source",
        *LOG_ORDER,
        *[verdict[c].alias(c) for c in ("rejection_reason", "schema_version", "shape_fingerprint", "unknown_fields_json")],
        "raw_json",
        "batch_id",
        X.now().alias("rejected_at"),
    )
    repeats = ranked.where("rank > 1").select(
        "occurrence_id",
        verdict["event_id"].alias("event_id"),
        "source",
        *LOG_ORDER,
        "payload_sha256",
        F.lit("repeated_source_commit").alias("duplicate_reason"),
        "batch_id",
        X.now().alias("detected_at"),
    )
    # The first occurrence of a shape, by an aggregate that combines before it shuffles.
    shaped = staged.where(verdict["shape_fingerprint"].isNotNull())
    first = shaped.groupBy(verdict["shape_fingerprint"].alias("shape_fingerprint")).agg(
        F.min_by(
            F.struct(verdict["schema_version"].alias("schema_version"), verdict["unknown_fields_json"].alias("unknown_fields_json"), F.col("occurrence_id"), verdict["rejection_reason"].alias("sample_rejection_reason")),
            F.struct(*LOG_ORDER),
        ).alias("first")
    )
    shapes = first.select("shape_fingerprint", "first.*").withColumn("first_seen_at", X.now())
    return Outputs(canonical, quarantine, repeats, shapes)


def placed(staged: DataFrame) -> DataFrame:
    """One row: how many judged occurrences are canonical, quarantined and duplicates.

    One aggregate by logical event tells all three: of n accepted occurrences
    of a commit one is canonical and n - 1 are duplicates.
    """
    verdict = F.col("verdict")
    each = staged.groupBy(verdict["event_id"].alias("event_id"), verdict["rejection_reason"].isNull().alias("ok")).agg(F.count(F.lit(1)).alias("n"))
    return each.agg(
        F.coalesce(F.sum(F.when(F.col("ok"), 1)), F.lit(0)).alias("canonical"),
        F.coalesce(F.sum(F.when(~F.col("ok"), F.col("n"))), F.lit(0)).alias("quarantined"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n") - 1)), F.lit(0)).alias("duplicates"),
    )


def unplaced(staged: DataFrame, out: Outputs) -> DataFrame:
    """Occurrences that aren't in exactly one of canonical, quarantine and repeats: (occurrence_id, places)."""
    places = out.canonical.select("occurrence_id").unionByName(out.quarantine.select("occurrence_id")).unionByName(out.repeats.select("occurrence_id"))
    counted = places.groupBy("occurrence_id").agg(F.count(F.lit(1)).alias("places"))
    return staged.select("occurrence_id").join(counted, "occurrence_id", "full_outer").select("occurrence_id", F.coalesce("places", F.lit(0)).alias("places")).where("places <> 1")
