"""The jobs that carry events from landed batches to corrected windows.

Every write is idempotent: a job that stopped anywhere can simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contract import Contract
from ..operators import checks, merge, native, reliable, windows
from ..schemas import RAW, WINDOW_KEY
from ..sources import batches
from ..streaming.watermark import shared_folder
from .store import Store

LOG_KEY = ["log_topic", "log_partition", "log_offset"]


def settled(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, so several writes don't compute it anew."""
    path = shared_folder(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ingest(store: Store, root: str, *, source: str = "events", topic: str = "events.v1", limit: int = batches.MAX_PENDING, fair: bool = False) -> int:
    """Takes the next committed batches into raw_events; returns how many.

    A damaged batch fails the run before anything is written.  Events go in
    before the batches are logged, so a stop in between leads to a harmless
    replay.
    """
    spark = store.spark
    log = store["ingested_batches"]
    todo = batches.pending(batches.committed(spark, root, source), log.read(), limit, fair=fair)
    chosen = spark.createDataFrame(todo.collect(), todo.schema)  # at most ``limit`` rows, listed once
    described = batches.verified(spark, root, batches.manifests(spark, root, chosen, topic))
    described = spark.createDataFrame(described.collect(), described.schema)
    n = described.count()
    if not n:
        return 0
    landed = batches.require_consistent(batches.load(spark, described), described)
    raw = batches.with_provenance(landed)
    store["raw_events"].insert_new(raw.select(*RAW.names), LOG_KEY)
    done = described.select("batch_id", F.col("data_path").alias("landing_path"), F.col("sha256").alias("events_sha256"), "record_count").withColumn("processed_at", F.expr("cast(current_timestamp() as timestamp_ntz)"))
    log.insert_new(done, ["batch_id"])
    return n


def normalize_native(store: Store, *, source: str = "events", collection: str = "post", strict: bool = False) -> None:
    own = store["raw_events"].read().where(F.col("source") == source)
    staged = settled(store.spark, native.stage(own, collection=collection, strict=strict))  # parsed once for both products
    store["canonical_native"].insert_new(native.canonical(staged), ["event_id"])
    store["rejected_native"].insert_new(native.rejected(staged), ["event_id"])


def validate_contract(store: Store, contract: Contract = Contract(), *, rebuild: bool = False) -> None:
    """Judges the raw events and merges the four products, judging each event once.

    Inserts alone never change a winner.  ``rebuild`` replaces all four tables,
    so a commit's first log occurrence wins even if it arrived later, and what
    a newer contract accepts leaves quarantine.
    """
    spark = store.spark
    staged = settled(spark, reliable.judged(reliable.occurrences(store["raw_events"].read(), contract.source), contract))
    out = reliable.outputs(staged)
    products = {"canonical_events": (out.canonical, "event_id"), "quarantine": (out.quarantine, "occurrence_id"), "duplicate_occurrences": (out.repeats, "occurrence_id"), "schema_observations": (out.shapes, "shape_fingerprint")}
    for name, (rows, key) in products.items():
        if rebuild:
            store[name].replace(rows, "rebuild")
        else:
            store[name].insert_new(rows, [key])


def misplaced(store: Store, source: str = "events") -> DataFrame:
    """Raw occurrences that aren't in exactly one of canonical, quarantine and duplicates: what inserts alone can leave."""
    found = reliable.occurrences(store["raw_events"].read(), source)
    tables = reliable.Outputs(store["canonical_events"].read(), store["quarantine"].read(), store["duplicate_occurrences"].read(), store["schema_observations"].read())
    return reliable.unplaced(found, tables)


@dataclass
class Refreshed:
    posts: int
    windows: int


def refresh_windows(store: Store, *, source: str = "events") -> Refreshed:
    """Recomputes all windows of the source and makes post_windows equal to them, changing only rows that differ."""
    spark = store.spark
    events, table = store["canonical_events"].read(), store["post_windows"]
    posts = windows.created_posts(events, source).count()
    existing = table.read().where(F.col("source") == source).count()
    checks.guard_empty(posts, existing)
    snapshot = settled(spark, windows.post_windows(events, source))
    merge.require_unique(snapshot, WINDOW_KEY)
    table.replace(merge.full_snapshot(table.read(), snapshot, source), "merge snapshot")
    checks.require_reconciled(table.read(), posts, source)
    return Refreshed(posts, snapshot.count())
