"""Quality checks: batch statistics, duplicate keys, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import QualityError
from ..functions import exprs as X


def invalid_landing_record() -> Column:
    """Whether a landed record lacks what every record has."""
    required = ["source", "log_topic", "log_partition", "log_offset", "log_key", "source_time_us", "landed_at", "raw_json"]
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return missing | (F.col("source_time_us") <= 0) | (F.col("source_time_us") >= X.TIME_END_US)


def batch_stats(landed: DataFrame, *by: str) -> DataFrame:
    """Records, distinct offsets, offset range and invalid records, in one pass."""
    stats = [
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct("log_offset").alias("distinct_offsets"),
        F.min("log_offset").alias("first_offset"),
        F.max("log_offset").alias("last_offset"),
        F.sum(X.flag(invalid_landing_record())).cast("long").alias("invalid_records"),
    ]
    return landed.groupBy(*by).agg(*stats) if by else landed.agg(*stats)


def repeated(table: DataFrame, *key: str) -> DataFrame:
    """(key, occurrences) of every key that more than one row has."""
    return table.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def counts(**tables: DataFrame) -> DataFrame:
    """One row with each table's row count; the counts are side by side, not joined by key."""
    singles = [t.agg(F.count(F.lit(1)).alias(name)) for name, t in tables.items()]
    return reduce(lambda a, b: a.crossJoin(b), singles)  # one row each


def reconcile(raw: DataFrame, canonical: DataFrame, quarantined: DataFrame, duplicates: DataFrame) -> DataFrame:
    each = counts(raw=raw, canonical=canonical, quarantined=quarantined, duplicates=duplicates)
    return each.withColumn("unaccounted", F.col("raw") - (F.col("canonical") + F.col("quarantined") + F.col("duplicates")))


def reconcile_placed(raw: DataFrame, placed: DataFrame) -> DataFrame:
    """The same before the products are written, from one row of their counts."""
    each = raw.agg(F.count(F.lit(1)).alias("raw")).crossJoin(placed)  # one row each
    return each.withColumn("unaccounted", F.col("raw") - (F.col("canonical") + F.col("quarantined") + F.col("duplicates")))


def guard_empty(post_count: int, window_count: int) -> None:
    """No reconciliation of existing windows with a source that has become empty."""
    if post_count == 0 and window_count:
        raise QualityError("windows exist but there are no canonical posts; refusing to delete them all")


def require_reconciled(windows: DataFrame, post_count: int, source: str) -> None:
    total = windows.where(F.col("source") == source).agg(F.coalesce(F.sum("post_count"), F.lit(0)).alias("n")).first()["n"]
    if total != post_count:
        raise QualityError(f"windows count {total} posts, there are {post_count}")
