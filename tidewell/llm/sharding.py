"""Sharding by extendible hashing, in DataFrame operations alone.

The directory is indexed by the leading bits of a document key's hash.  All
documents start in one bucket of depth 0; only a bucket over the byte limit
splits on its next bit, until every bucket fits.  Sizes by prefix are
aggregated for a level of ``STEP`` bits at a time, the still oversized
buckets alone go on to the next level, and the directory stays a DataFrame:
nothing reaches the driver but the count of buckets still open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import checkpointed, read

#: Byte limit of a shard.
SHARD_BYTES = 1 << 20
#: Bits that the directory grows by at once, and bits in the hash.
STEP, BITS = 8, 32


def hash_bits(key: Column) -> Column:
    """The first 32 bits of the MD5 of the key as text, as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def _prefix(bits: Column, depth: Column | int) -> Column:
    return F.floor(bits / F.pow(F.lit(2.0), BITS - (F.lit(depth) if isinstance(depth, int) else depth))).cast("long")


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes, docs, oversized): the leaves that hold any of ``sizes`` (bits, size, docs).

    Buckets that still exceed the limit at 32 bits hold one key, or one
    document, that is larger than a shard; they stay whole and are marked.
    """
    leaves = None
    open_ = sizes
    for base in range(0, BITS, STEP):
        top = min(base + STEP, BITS)
        fine = open_.groupBy(_prefix(F.col("bits"), top).alias("p")).agg(F.sum("size").alias("size"), F.sum("docs").alias("docs"))
        first = 0 if base == 0 else base + 1
        each = fine.select("p", "size", "docs", F.explode(F.sequence(F.lit(first), F.lit(top))).alias("depth"))
        each = each.select("depth", F.floor(F.col("p") / F.pow(F.lit(2.0), F.lit(top) - F.col("depth"))).cast("long").alias("prefix"), "size", "docs")
        nodes = each.groupBy("depth", "prefix").agg(F.sum("size").alias("size"), F.sum("docs").alias("docs"))
        parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"), F.col("size").alias("above"))
        # A leaf fits and its parent doesn't; at this level's top, what doesn't fit stays open.
        joined = nodes.withColumn("up", F.floor(F.col("prefix") / 2)).join(parents, ["depth", "up"], "left")
        inner = F.col("above").isNull() | (F.col("above") > limit)
        level = checkpointed(joined.where(inner & ((F.col("size") <= limit) | (F.col("depth") == top))).select("depth", "prefix", "size", "docs"))
        done = level.where(F.col("size") <= limit) if top < BITS else level
        leaves = done if leaves is None else leaves.unionByName(done)
        if top == BITS:
            break
        wide = level.where(F.col("size") > limit).select(F.col("prefix").alias("p"))
        if wide.isEmpty():
            break
        open_ = open_.withColumn("p", _prefix(F.col("bits"), top)).join(wide, "p", "left_semi").select("bits", "size", "docs")
    return leaves.select("depth", "prefix", F.col("size").alias("bytes"), "docs", (F.col("size") > limit).alias("oversized"))


def assign_shards(docs: DataFrame, *, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Adds shard_depth, shard_prefix, shard_bytes, shard_docs, shard_oversized to each row.

    A document's size is its text's UTF-8 bytes, 0 for null.  Rows with one
    key, null keys included, share a shard, which is marked oversized if they
    exceed the limit together.  An input column of these names gives way.
    """
    new = ["shard_depth", "shard_prefix", "shard_bytes", "shard_docs", "shard_oversized"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    rows = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(kept)], hash_bits(docs[key]).alias("bits"), F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long").alias("size"))
    sizes = checkpointed(rows.groupBy("bits").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")))
    leaves = directory(sizes, limit)
    # Each hash finds its leaf by equality, at the depths that the directory has.
    depths = F.sequence(F.lit(0), F.lit(BITS))
    at = sizes.select("bits", F.explode(depths).alias("depth")).join(F.broadcast(leaves.select("depth").distinct()), "depth", "left_semi")
    found = at.withColumn("prefix", _prefix(F.col("bits"), F.col("depth"))).join(leaves, ["depth", "prefix"])
    out = rows.join(found, "bits")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], F.col("depth").alias("shard_depth"), F.col("prefix").alias("shard_prefix"), F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs"), F.col("oversized").alias("shard_oversized"))


def write_shards(docs: DataFrame, path: str, *, limit: int = SHARD_BYTES, **options) -> None:
    """Writes each shard under ``path`` as a Parquet folder shard=<depth>-<prefix>.

    An oversized shard, of one key or one document, is written by as many
    tasks as it has limits' worth of bytes.  Null texts have no bytes, rows
    with a null key share a shard, repeated rows are all written, and an empty
    table writes none.
    """
    placed = assign_shards(docs, limit=limit, **options)
    name = F.concat_ws("-", F.col("shard_depth"), F.col("shard_prefix"))
    writer = F.pmod(F.monotonically_increasing_id(), F.ceil(F.greatest(F.col("shard_bytes"), F.lit(1)) / limit))
    dealt = placed.withColumns({"shard": name, "shard_writer": writer}).repartition("shard", "shard_writer")
    dealt.drop("shard_depth", "shard_prefix", "shard_bytes", "shard_docs", "shard_oversized", "shard_writer").write.partitionBy("shard").parquet(path)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"), keep=["doc_id"])


OP9_SQL = f"""
WITH d AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS bits, CAST(coalesce(strlen(text), 0) AS BIGINT) AS size
  FROM documents),
n AS (
  SELECT depth, bits // CAST(pow(2, {BITS} - depth) AS BIGINT) AS prefix, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS docs
  FROM d, (SELECT unnest(range(0, {BITS} + 1)) AS depth) GROUP BY ALL),
fits AS (
  SELECT doc_id, min(n.depth) AS depth
  FROM d JOIN n ON n.prefix = bits // CAST(pow(2, {BITS} - n.depth) AS BIGINT) WHERE n.bytes <= {SHARD_BYTES} OR n.depth = {BITS} GROUP BY doc_id)
SELECT d.doc_id, CAST(n.depth AS INTEGER) AS shard_depth, n.prefix AS shard_prefix, n.bytes AS shard_bytes, n.docs AS shard_docs, n.bytes > {SHARD_BYTES} AS shard_oversized
FROM d JOIN fits USING (doc_id) JOIN n ON n.depth = fits.depth AND n.prefix = bits // CAST(pow(2, {BITS} - n.depth) AS BIGINT)
"""
