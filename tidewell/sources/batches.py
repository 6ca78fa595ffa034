"""Committed landing batches as DataFrames: found, verified and read by the executors.

A batch is a folder ``<source>_p<partition>_o<first>-<last>`` with the data
file and, written last, a manifest.  A folder without a manifest is unfinished
and is left alone; a manifest without data is an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import BatchError
from ..functions import exprs as X
from ..operators import checks
from ..schemas import LANDING, MANIFEST

DATA, MANIFEST_FILE = "events.jsonl", "manifest.json"
# Fixed limits of a batch.
MAX_DATA_BYTES, MAX_MANIFEST_BYTES = 16 << 20, 64 << 10
MAX_PENDING = 20
NAME = r"_p([0-9]{3})_o([0-9]{20})-([0-9]{20})$"


def _files(spark: SparkSession, root: str) -> DataFrame:
    """(path, folder, name, length, content); content is read only where it is asked for."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select("path", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length", "content")


def committed(spark: SparkSession, root: str, source: str = "events") -> DataFrame:
    """(batch_id, log_partition, first_offset, last_offset, data_path) of each batch with a manifest.

    Raises BatchError if one lacks its data.
    """
    own = _files(spark, root).where(F.col("folder").rlike(f"^{source}{NAME}"))
    of = lambda name: own.where(F.col("name") == name)
    both = of(MANIFEST_FILE).select("folder").join(of(DATA).select("folder", F.col("path").alias("data_path")), "folder", "left")
    if lost := both.where("data_path IS NULL").limit(1).collect():
        raise BatchError(f"committed batch without data: {lost[0]['folder']}")
    part = lambda i, kind: F.regexp_extract("folder", NAME, i).cast(kind)
    return both.select(F.col("folder").alias("batch_id"), part(1, "int").alias("log_partition"), part(2, "long").alias("first_offset"), part(3, "long").alias("last_offset"), "data_path")


def pending(batches: DataFrame, log: DataFrame, limit: int = MAX_PENDING, *, fair: bool = False) -> DataFrame:
    """Committed batches that the ingestion log lacks: the first by id, or in turn from each log partition if ``fair``."""
    todo = batches.join(log.select("batch_id").distinct(), "batch_id", "left_anti")
    if fair:
        from pyspark.sql import Window

        todo = todo.withColumn("turn", F.row_number().over(Window.partitionBy("log_partition").orderBy("first_offset")))
        return todo.orderBy("turn", "log_partition").limit(limit).drop("turn")
    return todo.orderBy("batch_id").limit(limit)


def _first_problem(rules: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(what)) for bad, what in rules])


def manifests(spark: SparkSession, root: str, batches: DataFrame, topic: str) -> DataFrame:
    """``batches`` with record_count, size_bytes, sha256 and the manifest's first problem, if any.

    Numbers must be JSON integers: strings, booleans and fractions read as null.
    """
    files = _files(spark, root).where(F.col("name") == MANIFEST_FILE)
    text = F.when(F.col("length") <= MAX_MANIFEST_BYTES, F.col("content").cast("string"))
    read = files.select(F.col("folder").alias("batch_id"), F.col("length").alias("manifest_bytes"), F.from_json(text, MANIFEST).alias("m"))
    joined = batches.join(read, "batch_id")
    m = F.col("m")
    rules = [
        (F.col("manifest_bytes") > MAX_MANIFEST_BYTES, "manifest exceeds the size limit"),
        (reduce(lambda a, b: a | b, [m[c].isNull() for c in ("batch_id", "log_topic", "log_partition", "record_count", "size_bytes", "sha256")]), "manifest lacks a required field"),
        (m["batch_id"] != F.col("batch_id"), "batch id mismatch"),
        (m["log_topic"] != topic, "unexpected topic"),
        (m["log_partition"] != F.col("log_partition"), "partition mismatch"),
        ((m["record_count"] <= 0) | (m["size_bytes"] <= 0), "counts must be positive"),
        (m["size_bytes"] > MAX_DATA_BYTES, "data exceeds the size limit"),
        (~m["sha256"].rlike("^[0-9a-f]{64}$"), "invalid checksum"),
        (F.col("first_offset") > F.col("last_offset"), "offset range is reversed"),
    ]
    return joined.select(*batches.columns, *[m[c].alias(c) for c in ("record_count", "size_bytes", "sha256")], _first_problem(rules).alias("problem"))


def verified(spark: SparkSession, root: str, described: DataFrame) -> DataFrame:
    """``described`` with ``problem`` also telling of data that isn't what the manifest says; checksums run on the executors."""
    data = _files(spark, root).where((F.col("name") == DATA) & (F.col("length") <= MAX_DATA_BYTES))
    found = data.select(F.col("folder").alias("batch_id"), F.length("content").alias("got_bytes"), F.sha2("content", 256).alias("got_sha256"))
    joined = described.join(found, "batch_id", "left")
    rules = [(F.col("got_bytes") != F.col("size_bytes"), "data size mismatch"), (F.col("got_sha256") != F.col("sha256"), "data checksum mismatch")]
    return joined.withColumn("problem", F.coalesce("problem", _first_problem(rules))).select(*described.columns)


def load(spark: SparkSession, verified_batches: DataFrame) -> DataFrame:
    """The landed records of verified batches, with batch_id and landing_path; malformed lines fail."""
    rows = verified_batches.select("batch_id", "data_path", "problem").collect()  # at most MAX_PENDING
    if bad := [r for r in rows if r["problem"]]:
        raise BatchError(f"{bad[0]['batch_id']}: {bad[0]['problem']}")
    if not rows:
        return spark.createDataFrame([], LANDING).withColumns({"batch_id": F.lit(None).cast("string"), "landing_path": F.lit(None).cast("string")})
    read = spark.read.schema(LANDING).option("mode", "FAILFAST").json([r["data_path"] for r in rows])
    path = F.col("_metadata.file_path")
    return read.select("*", F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("batch_id"), path.alias("landing_path"))


def require_consistent(landed: DataFrame, verified_batches: DataFrame) -> DataFrame:
    """``landed``, or BatchError if a batch's records contradict its manifest.  Gaps between offsets are allowed."""
    stats = checks.batch_stats(landed, "batch_id").select("batch_id", *[F.col(c).alias(f"got_{c}") for c in ("record_count", "distinct_offsets", "first_offset", "last_offset", "invalid_records")])
    both = verified_batches.join(stats, "batch_id", "left")
    rules = [
        (F.col("got_record_count") != F.col("record_count"), "record count mismatch"),
        (F.col("got_distinct_offsets") != F.col("record_count"), "repeated offsets"),
        (F.col("got_first_offset") != F.col("first_offset"), "first offset mismatch"),
        (F.col("got_last_offset") != F.col("last_offset"), "last offset mismatch"),
        (F.col("got_invalid_records") != 0, "invalid records"),
    ]
    bad = both.withColumn("problem", _first_problem(rules)).where("problem IS NOT NULL").limit(1).collect()
    if bad:
        raise BatchError(f"{bad[0]['batch_id']}: {bad[0]['problem']}")
    return landed


def with_provenance(landed: DataFrame) -> DataFrame:
    return landed.withColumn("ingested_at", X.now())
