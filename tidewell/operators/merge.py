"""MERGE as pure functions: (target, incoming) to the table that results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import QualityError
from ..schemas import MEASURES, WINDOW_KEY


def require_unique(incoming: DataFrame, key: list[str]) -> DataFrame:
    """``incoming``, or QualityError if two of its rows have one key, as MERGE would fail."""
    if not incoming.groupBy(*key).count().where("count > 1").isEmpty():
        raise QualityError(f"incoming rows repeat a key of {key}")
    return incoming


def new_rows(target: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows whose key the target hasn't; a null in the key matches nothing."""
    return incoming.join(target.select(*key).distinct(), key, "left_anti").select(*incoming.columns)


def insert_only(target: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """The target and the rows that are new to it; a row in the target never changes."""
    return target.unionByName(new_rows(target, incoming, key), allowMissingColumns=False)


def full_snapshot(target: DataFrame, snapshot: DataFrame, source: str, *, key: list[str] = WINDOW_KEY, measures: list[str] = MEASURES) -> DataFrame:
    """The target made equal to a complete snapshot of one source.

    A row whose measures all agree, nulls included, stays as it is with its
    old timestamp; others are replaced, new ones inserted, and the source's
    rows that the snapshot lacks go.  Other sources' rows stay.
    """
    columns = target.columns
    old = target.select(*[F.col(c).alias(f"o_{c}") for c in columns], F.lit(True).alias("had"))
    new = snapshot.select(*[F.col(c).alias(f"n_{c}") for c in columns], F.lit(True).alias("has"))
    on = reduce(lambda a, b: a & b, [F.col(f"o_{k}") == F.col(f"n_{k}") for k in key])
    both = old.join(new, on, "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"o_{m}").eqNullSafe(F.col(f"n_{m}")) for m in measures])
    keep_old = F.col("had").isNotNull() & (F.col("has").isNull() | same)
    gone = F.col("has").isNull() & (F.col("o_source") == source)
    return both.where(~F.coalesce(gone, F.lit(False))).select(*[F.when(keep_old, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c) for c in columns])
