"""Benchmark decontamination: a broadcast set of normalised test n-grams.

A benchmark item's windows are its runs of ``window`` normalised words; an item
with fewer words, but not none, is one window.  Training texts are scanned once:
words are looked up in the benchmark's vocabulary, window hashes in its sorted
hash set, and each hit is verified word for word.  Pairs of a window and an
item that has it are broadcast in blocks of about ``BLOCK_WINDOWS``, whatever
windows and items they are of.  A task holds one block at a time and takes the
more text between two the more blocks there are, so a benchmark of any size is
handled exactly in bounded memory, and loading blocks stays a small part of
the work.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import checkpointed, mix64, read, shared_folder, ship
from .textkernel import ALNUM_LOWER, CHUNK_BYTES, Words, inside, map_text, rolling_hash

WINDOW = 13
#: Windows in a broadcast block, about: some 25 MB with their words.
BLOCK_WINDOWS = 200_000
#: Most times that a chunk of text grows with the number of blocks.
MOST_CHUNKS = 16

_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def _windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct rows (words, item): windows and items that have them, null where an item has no id."""

    def rows(texts, _):
        words = Words(texts, ALNUM_LOWER)
        out = []
        names = words.uniq.to_pylist()
        for a, b in zip(words.offs[:-1], words.offs[1:], strict=True):
            own = [names[c] for c in words.codes[a:b]]
            out.append([" ".join(own[i : i + window]) for i in range(max(1, len(own) - window + 1))] if own else [])
        return [out]

    found = map_text(benchmark, rows, [T.StructField("windows", T.ArrayType(T.StringType()))], text, [item_id])
    return found.select(F.explode("windows").alias("words"), F.col(item_id).cast("string").alias("item")).distinct()


def _block(rows) -> dict:
    items: dict[str, list] = {}
    for r in rows:
        items.setdefault(r["words"], []).extend([] if r["item"] is None else [r["item"]])
    vocab = sorted({w for words in items for w in words.split(" ")})
    code = {w: i for i, w in enumerate(vocab)}
    by_len: dict[int, list] = {}
    for words, names in items.items():
        ids = [code[w] for w in words.split(" ")]
        by_len.setdefault(len(ids), []).append((ids, names))
    tables = {}
    salt = mix64(np.arange(1, len(vocab) + 1, dtype=np.uint64))
    for size, entries in by_len.items():
        ids = np.array([e[0] for e in entries], np.int32)
        hashes = rolling_hash(salt[ids].ravel(), size)[::size]
        order = np.argsort(hashes, kind="stable")
        tables[size] = (hashes[order], ids[order], [entries[i][1] for i in order])
    return {"vocab": pa.array(vocab, pa.string()), "salt": salt, "tables": tables}


def _blocks(spark: SparkSession, windows: DataFrame) -> list:
    """The windows as broadcast blocks, gathered one bounded block at a time; they are computed once."""
    windows = checkpointed(windows)
    n = windows.count()
    if n == 0:
        return []
    parts = -(-n // BLOCK_WINDOWS)
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("words", "item"), F.lit(parts)))
    path = f"{shared_folder(spark)}/windows"
    dealt.repartition(parts, "block").write.partitionBy("block").parquet(path)
    stored = spark.read.schema("words string, item string, block long").parquet(path)
    gathered = (stored.where(F.col("block") == k).select("words", "item").collect() for k in range(parts))
    return [spark.sparkContext.broadcast(_block(rows)) for rows in gathered if rows]


def _hits(words: Words, block: dict) -> tuple[np.ndarray, dict[int, set]]:
    """(whether each word is in an occurring window, items by document)."""
    total = len(words)
    covered = np.zeros(total + 1, np.int32)
    items: dict[int, set] = {}
    at = pc.index_in(words.uniq, value_set=block["vocab"])
    codes = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int32)[words.codes]
    known = codes >= 0
    values = np.where(known, block["salt"][codes], np.uint64(0))
    strange = np.concatenate([[0], np.cumsum(~known)])
    doc = words.doc_of()
    for size, (hashes, ids, names) in block["tables"].items():
        if total < size:
            continue
        ok = inside(doc, size) & (strange[size:] == strange[:-size])
        starts = np.flatnonzero(ok)
        if not len(starts):
            continue
        own = rolling_hash(values, size)[starts]
        left = np.searchsorted(hashes, own, side="left")
        right = np.searchsorted(hashes, own, side="right")
        for step in range(int((right - left).max(initial=0))):
            some = np.flatnonzero(left + step < right)
            s, row = starts[some], left[some] + step
            same = np.ones(len(some), bool)
            for j in range(size):
                same &= codes[s + j] == ids[row, j]
            s, row = s[same], row[same]
            np.add.at(covered, s, 1)
            np.add.at(covered, s + size, -1)
            pairs = np.unique(doc[s].astype(np.int64) * len(names) + row)
            for d, r in zip(pairs // len(names), pairs % len(names), strict=True):
                items.setdefault(int(d), set()).update(names[r])
    return np.cumsum(covered[:total]) > 0, items


def scan_contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", keep: list[str] | None = None, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, cleaned: bool = False) -> DataFrame:
    """Adds n_words, n_hit, items (sorted ids as strings), contaminated; with ``cleaned`` also clean_text.

    A word inside any occurring window is hit; a document is contaminated if
    n_hit > 0 and 20 * n_hit >= n_words.  clean_text is the text without the
    hit spans (from a run's first hit word to its last).  Null or blank texts
    have no words and no hits, null items none to match; an item without an id
    is hit like any other and isn't named.  Rows with equal ids are judged each
    by itself.  An input column named like a result gives way to it.
    """
    spark = docs.sparkSession
    ship(spark)
    blocks = _blocks(spark, _windows(benchmark, item_id, item_text, window))

    def scan(texts, _):
        words = Words(texts, ALNUM_LOWER)
        hit = np.zeros(len(words), bool)
        items: dict[int, set] = {}
        for b in blocks:
            h, found = _hits(words, b.value)
            hit |= h
            for d, names in found.items():
                items.setdefault(d, set()).update(names)
            if len(blocks) > 1:
                b.__dict__.pop("_value", None)  # the next block takes its place in memory
        sums = np.concatenate([[0], np.cumsum(hit)])
        n_hit = sums[words.offs[1:]] - sums[words.offs[:-1]]
        n_words = words.counts
        out = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), [sorted(items.get(d, ())) for d in range(words.n_docs)], pa.array((n_hit > 0) & (20 * n_hit >= n_words))]
        if cleaned:
            kept = []
            for d, t in enumerate(texts.to_pylist()):
                if n_hit[d]:
                    spans = [m.span() for m in _WORD.finditer(t)]
                    own = np.flatnonzero(hit[words.offs[d] : words.offs[d + 1]])
                    cut = [(int(r[0]), int(r[-1])) for r in np.split(own, np.flatnonzero(np.diff(own) > 1) + 1)]
                    last, pieces = 0, []
                    for a, b in cut:
                        pieces.append(t[last : spans[a][0]])
                        last = spans[b][1]
                    t = "".join([*pieces, t[last:]])
                kept.append(t)
            out.append(pa.array(kept, pa.string()))
        return out

    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("contaminated", T.BooleanType())]
    if cleaned:
        fields.append(T.StructField("clean_text", T.StringType()))
    return map_text(docs, scan, fields, text, keep, CHUNK_BYTES * max(1, min(len(blocks), MOST_CHUNKS)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", text: str = "text", **options) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``) or without hit spans (``"spans"``).

    The columns stay those of ``docs``; working columns that clash with them
    are kept apart by scanning a renamed copy.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    prefix = "in_"
    renamed = docs.select(*[docs[c].alias(prefix + c) for c in docs.columns])
    found = scan_contamination(renamed, benchmark, text=prefix + text, cleaned=remove == "spans", **options)
    if remove == "documents":
        found = found.where(~F.col("contaminated"))
        return found.select(*[F.col(prefix + c).alias(c) for c in docs.columns])
    return found.select(*[F.col("clean_text" if c == text else prefix + c).alias(c) for c in docs.columns])


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


_SQL_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, size, item_id FROM dw JOIN bw USING (size, win)),
words_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
