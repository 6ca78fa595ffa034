"""Getting this package's code to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_tidewell_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tidewell_"), "tidewell_src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, str(file.relative_to(PACKAGE.parent)))
    sc.addPyFile(path)
    sc._tidewell_shipped = True


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: the session's ``spark.checkpoint.dir``.

    Only a session on this machine alone may leave it unset and gets a
    temporary folder; on a cluster that would be another folder on each node.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "tidewell_checkpoints")
