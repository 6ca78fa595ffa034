"""What the text operators share on the Spark side: code shipping, checkpoints, sizes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import runtime as base

#: Rows in an Arrow batch of whole texts, where the session leaves Spark's own 10,000.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Readies a session: code on the executors, Arrow batches that suit long texts."""
    base.ship(spark)
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, str(BATCH_ROWS))


def give_back() -> None:
    """Returns freed memory to the system, so idle workers stay small."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)



def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the session's shared checkpoint folder and cut its lineage."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base.shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see."""
    return f"{base.shared_root(spark)}/{uuid.uuid4().hex}"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of a text column: one aggregate that reads that column alone."""
    row = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("b")).first()
    return int(row["b"] or 0)


def mix64(x):
    """splitmix64's finaliser on a numpy uint64 array."""
    import numpy as np

    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
