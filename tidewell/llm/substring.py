"""Substring dedup by super-k-mer partitioning.

Documents are dealt to blocks by their id.  In a block, every window of
``window`` words has the least hash of its ``mini``-word runs as minimiser;
consecutive windows with one minimiser form a super-k-mer, and each distinct
super-k-mer of the block travels once, as the packed string of its words with
the least doc_id that has it, to the minimiser's bucket.  So a passage in a
third of all documents is one string from each block, whatever its copies.
A bucket sorts its windows by hash, compares equal ones word for word, finds
each window's least doc_id and returns one bit per window and string: whether
a smaller doc_id has that window too.  The block then marks every window that
an earlier document of its own has in the same string, or that has its bit set.

Any order of the runs gives the same result, so runs that would be the
minimisers of more than a bucket's worth of windows, as a sample shows, come
last in it: a window has one of them only if all its runs are such.  A bucket
that still grows beyond four times ``BUCKET_BYTES`` goes on in files on the
task's own disk, as Spark's sorts do, one for each share of the window hashes;
these are sorted one by one, and equal hashes are compared word for word there
too.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import checkpointed, mix64, read, ship, text_bytes
from .textkernel import SPACED, Words, chunks, gather_joined, inside, map_text, ranges, rolling_hash

WINDOW = 13
#: Words in a minimiser.
MINI = 3
#: Text bytes of a block of documents and of a bucket of super-k-mers, about.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20
#: Text bytes, or a thousandth of the text if that is more, in which frequent minimisers are looked for; most of them that are
#: put last.  Only the buckets' balance depends on either.
SAMPLE_BYTES, FREQUENT = 16 << 20, 1_000_000
#: Text bytes for each partition of an exchange, about.
PARTITION_BYTES = 32 << 20


def _slices(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of items, whose sizes sum up to ``ends``, of ``limit`` in all or one item."""
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, side="right")))
        yield a, b
        a = b


def _minimisers(hashes: np.ndarray, window: int, mini: int, frequent: np.ndarray) -> np.ndarray:
    """The least run of ``mini`` words in each window of words; frequent ones come last."""
    parts = rolling_hash(hashes, mini) >> np.uint64(1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, parts), len(frequent) - 1)
        parts |= (frequent[at] == parts).astype(np.uint64) << np.uint64(63)
    n = max(0, len(hashes) - window + 1)
    least = parts[:n].copy()
    for j in range(1, window - mini + 1):
        np.minimum(least, parts[j : j + n], out=least)
    return least


class _Block:
    """One block's words, windows and super-k-mers, the same at each look.

    Documents without an id have no windows: nothing is smaller than they are.
    """

    def __init__(self, ids: pa.Array, texts: pa.Array, window: int, mini: int, buckets: int, frequent: np.ndarray):
        named = pc.is_valid(ids).to_numpy(zero_copy_only=False)
        numbers = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.order = np.argsort(numbers, kind="stable")
        self.ids, named = numbers[self.order], named[self.order]
        self.words = words = Words(texts.take(pa.array(self.order)), SPACED)
        doc = words.doc_of()
        ok = inside(doc, window)
        ok = np.flatnonzero(ok & named[doc[: len(ok)]])
        hashes = words.hashes()
        least = _minimisers(hashes, window, mini, frequent)[ok]
        new = np.ones(len(ok), bool)
        new[1:] = (least[1:] != least[:-1]) | (np.diff(ok) != 1) | (doc[ok[1:]] != doc[ok[:-1]])
        at = np.flatnonzero(new)
        self.starts = ok[at]
        self.sizes = np.diff(np.append(at, len(ok)))  # windows in each super-k-mer
        self.spans = self.sizes + window - 1  # and words
        self.owner = self.ids[doc[self.starts]]
        self.bucket = (mix64(least[at]) % np.uint64(buckets)).astype(np.int64)
        # Strings with one hash come together; they are one if their words agree.
        low, high = self._sums(hashes), self._sums(mix64(hashes ^ np.uint64(0xA5A5A5A5)))
        order = np.lexsort((high, low, self.bucket))
        lead = np.ones(len(at), bool)
        for x in (self.bucket, low, high, self.spans):
            y = x[order]
            lead[1:] = y[1:] != y[:-1] if x is self.bucket else lead[1:] | (y[1:] != y[:-1])
        lead |= self._strange(order, lead)
        # Each string's place among the distinct ones, in the order of buckets; the sort is stable, so the least id leads.
        self.place = np.empty(len(at), np.int64)
        self.place[order] = np.cumsum(lead) - 1
        self.leaders = order[lead]

    def _strange(self, order: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """Strings, in ``order``, whose words aren't those of the one before with the same hash; they lead a run of their own.

        A run that is cut so may split equal strings; its bucket compares them again.
        """
        out = np.zeros(len(order), bool)
        at = np.flatnonzero(~lead)
        spans = np.cumsum(self.spans[order[at]])
        for a, b in _slices(spans, 1 << 20):
            own, before = order[at[a:b]], order[at[a:b] - 1]
            size, codes = self.spans[own], self.words.codes
            differs = codes[ranges(self.starts[own], size)] != codes[ranges(self.starts[before], size)]
            out[at[a:b]] = np.add.reduceat(differs, np.cumsum(size) - size) > 0
        return out

    def _sums(self, hashes: np.ndarray) -> np.ndarray:
        """Hash of each super-k-mer's words in order, from prefix sums."""
        base = 0x9E3779B97F4A7C15
        n = len(hashes)

        def powers(x: int) -> np.ndarray:
            out = np.full(n + 1, x, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers(base)[:n], out=sums[1:])
        return mix64((sums[self.starts + self.spans] - sums[self.starts]) * powers(pow(base, -1, 1 << 64))[self.starts])

    def packed(self) -> Iterator[tuple[int, int, bytes]]:
        """(bucket, strings, blob): a blob has each string's least id and length, then the words."""
        lead, words = self.leaders, self.words
        if not len(lead):
            return
        spans, buckets = self.spans[lead], self.bucket[lead]
        data, ends = gather_joined(words.uniq, words.codes[ranges(self.starts[lead], spans)])
        ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(spans)])]
        cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(lead)]
        squeeze = zstandard.ZstdCompressor(level=6)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            head = np.stack([self.owner[lead[a:b]], spans[a:b]], axis=1).astype("<i8")
            yield int(buckets[a]), b - a, squeeze.compress(head.tobytes() + data[ends[a] : ends[b]].tobytes())

    def removed(self, answers: dict[int, bytes], window: int) -> np.ndarray:
        """Whether each word is in a window that a smaller id has, given the buckets' bits."""
        sizes, buckets = self.sizes[self.leaders], self.bucket[self.leaders]
        at = np.cumsum(sizes) - sizes
        seen = np.zeros(int(sizes.sum()), bool)
        for bucket, bits in answers.items():
            a, b = np.searchsorted(buckets, [bucket, bucket + 1])
            n = int(sizes[a:b].sum())
            seen[at[a] : at[a] + n] = np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(bits), np.uint8), count=n).astype(bool)
        early = self.owner[self.leaders][self.place] < self.owner
        hit = seen[ranges(at[self.place], self.sizes)] | np.repeat(early, self.sizes)
        starts = ranges(self.starts, self.sizes)[hit]
        marks = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + window, -1)
        return np.cumsum(marks)[:-1] > 0


class _Strings:
    """One blob unpacked: the strings' least ids, their windows' hashes and places."""

    def __init__(self, n: int, blob: bytes, window: int):
        raw = zstandard.ZstdDecompressor().decompress(blob)
        head = np.frombuffer(raw, "<i8", 2 * n).reshape(n, 2)
        self.body, spans = raw[16 * n :].decode(), head[:, 1]
        self.sizes = spans - window + 1
        self.ids = np.repeat(head[:, 0], self.sizes)
        self.starts = ranges(np.cumsum(spans) - spans, self.sizes)


class _Files:
    """A bucket's windows on disk: their words, and records by share of the hashes."""

    def __init__(self, window: int):
        self.window = window
        self.words = tempfile.TemporaryFile()
        self.shares = [tempfile.TemporaryFile() for _ in range(64)]
        self.total = self.bytes = 0

    def add(self, strings: _Strings) -> None:
        body = strings.body.encode()
        ends = np.flatnonzero(np.frombuffer(body, np.uint8) == 32)  # a space behind each word
        begins = np.concatenate([[0], ends[:-1] + 1])
        out = np.zeros(len(strings.starts), _RECORD)
        out["h"] = rolling_hash(Words(pa.array([strings.body]), SPACED).hashes(), self.window)[strings.starts]
        out["id"], out["at"] = strings.ids, self.total + np.arange(len(out))
        out["pos"] = self.bytes + begins[strings.starts]
        out["len"] = ends[strings.starts + self.window - 1] - begins[strings.starts]
        share = (out["h"] >> np.uint64(58)).astype(int)
        for k in np.unique(share):
            self.shares[k].write(out[share == k].tobytes())
        self.words.write(body)
        self.total += len(out)
        self.bytes += len(body)

    def bits(self) -> np.ndarray:
        bits = np.zeros(self.total, bool)
        self.words.flush()
        body = np.memmap(self.words, np.uint8, "r") if self.bytes else np.zeros(0, np.uint8)
        for f in self.shares:
            f.seek(0)
            own = np.frombuffer(f.read(), _RECORD)
            f.close()
            keys = [own["h"]] if self._agree(own, body) else [self._codes(own, body)]
            bits[own["at"][_beaten(keys, own["id"])]] = True
        return bits

    @staticmethod
    def _agree(own: np.ndarray, body: np.ndarray) -> bool:
        """Whether windows with one hash have the same words."""
        own = own[np.argsort(own["h"], kind="stable")]
        at = np.flatnonzero(own["h"][1:] == own["h"][:-1])
        x, y = own[at], own[at + 1]
        if (x["len"] != y["len"]).any():
            return False
        return all((body[ranges(x["pos"][a:b], x["len"][a:b])] == body[ranges(y["pos"][a:b], y["len"][a:b])]).all() for a, b in _slices(np.cumsum(x["len"]), 1 << 24))

    @staticmethod
    def _codes(own: np.ndarray, body: np.ndarray) -> np.ndarray:
        codes: dict[bytes, int] = {}
        return np.array([codes.setdefault(body[p : p + n].tobytes(), len(codes)) for p, n in zip(own["pos"].tolist(), own["len"].tolist(), strict=True)], np.int64)


class _Bucket:
    """Collects a bucket's blobs, then tells which of its windows a smaller id has too."""

    def __init__(self, bucket: int, window: int, limit: int):
        self.bucket, self.window, self.limit = bucket, window, limit
        self.blobs: list[tuple[int, int, bytes]] = []
        self.raw = 0
        self.files: _Files | None = None
        self.sent: list[tuple[int, int]] = []  # (block, windows) of what has gone to files

    def add(self, block: int, n: int, blob: bytes) -> None:
        self.blobs.append((block, n, blob))
        self.raw += zstandard.frame_content_size(blob)
        if self.raw > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.files = self.files or _Files(self.window)
        for block, n, blob in self.blobs:
            own = _Strings(n, blob, self.window)
            self.files.add(own)
            self.sent.append((block, len(own.starts)))
        self.blobs, self.raw = [], 0

    def answers(self) -> Iterator[tuple[int, np.ndarray]]:
        """(block, a bit for each window of its strings)."""
        if self.files is not None:
            self._spill()
            bits, sent = self.files.bits(), self.sent
        else:
            strings = [_Strings(n, blob, self.window) for _, n, blob in self.blobs]
            words = Words(pa.array(["".join(s.body for s in strings)], pa.string()), SPACED)
            base = np.cumsum([0, *[int(s.starts[-1]) + self.window for s in strings]])
            starts = np.concatenate([s.starts + b for s, b in zip(strings, base, strict=False)])
            ids = np.concatenate([s.ids for s in strings])
            bits = np.zeros(len(starts), bool)
            hashes = rolling_hash(words.hashes(), self.window)[starts]
            if _twins_agree(hashes, starts, words.codes, self.window):
                keys = [hashes]
            else:  # two windows with one hash: compare the words themselves
                keys = [words.codes[starts + j] for j in range(self.window)]
            bits[_beaten(keys, ids)] = True
            sent = [(block, len(s.starts)) for (block, _, _), s in zip(self.blobs, strings, strict=True)]
        at = 0
        for block, n in sent:
            yield block, bits[at : at + n]
            at += n


_RECORD = np.dtype([("h", "<u8"), ("id", "<i8"), ("at", "<i8"), ("pos", "<i8"), ("len", "<i8")])


def _beaten(keys: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Places whose key also has a smaller id: one sort, then each run's first id against the rest."""
    order = np.lexsort((ids, *keys))
    lead = np.zeros(len(order), bool)
    lead[:1] = True
    for k in keys:
        k = k[order]
        lead[1:] |= k[1:] != k[:-1]
    first = np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))
    ids = ids[order]
    return order[ids[first] < ids]


def _twins_agree(hashes: np.ndarray, starts: np.ndarray, codes: np.ndarray, window: int) -> bool:
    order = np.argsort(hashes, kind="stable")
    at = np.flatnonzero(hashes[order][1:] == hashes[order][:-1])
    a, b = starts[order[at]], starts[order[at + 1]]
    return all(bool((codes[a + j] == codes[b + j]).all()) for j in range(window))


def _count_buckets(batches: Iterator[pa.RecordBatch], window: int, limit: int) -> Iterator[pa.RecordBatch]:
    def done(b: _Bucket) -> Iterator[pa.RecordBatch]:
        for block, bits in b.answers():
            if bits.any():
                packed = zstandard.ZstdCompressor(level=1).compress(np.packbits(bits).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([b.bucket], pa.int64()), pa.array([packed], pa.binary())], names=["block", "bucket", "bits"])

    now = None
    for batch in batches:
        for i in range(batch.num_rows):
            bucket, block, n, blob = (c[i].as_py() for c in batch.columns)
            if now is not None and now.bucket != bucket:
                yield from done(now)
                now = None
            now = now or _Bucket(bucket, window, limit)
            now.add(block, n, blob)
    if now is not None:
        yield from done(now)


def _frequent(texts: DataFrame, total: int, buckets: int, window: int, mini: int) -> np.ndarray:
    """Sorted runs that are the minimisers of more than a bucket's worth of a sample's distinct windows."""
    share = min(1.0, max(SAMPLE_BYTES, total // 1000) / max(total, 1))
    sample = texts.where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = Words(part.column(0), SPACED)
                hashes = words.hashes()
                ok = np.flatnonzero(inside(words.doc_of(), window))
                _, first = np.unique(rolling_hash(hashes, window)[ok], return_index=True)
                runs, n = np.unique(_minimisers(hashes, window, mini, np.zeros(0, np.uint64))[ok[first]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), pa.array(n, pa.int64())], names=["run", "n"])

    found = checkpointed(sample.select("text").mapInArrow(count, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")))
    windows = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    top = found.where(F.col("n") >= max(8, windows // buckets)).orderBy(F.desc("n"), "run").limit(FREQUENT).toArrow()
    return np.sort(top.column("run").to_numpy().astype(np.uint64))


def drop_repeats(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, mini: int = MINI, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text.

    A word is removed if some window that covers it starts in a document with
    a smaller doc_id too, judged on the input; kept_text is the other words
    joined by one space.  Null and blank texts have no words, and a text of
    fewer words than a window loses none.  Rows with one doc_id don't remove
    each other's words; rows without a doc_id neither remove nor lose words.
    Other columns are not looked at.
    """
    if not 1 <= mini <= window:
        raise ValueError("a minimiser has from one word to a window's")
    spark = docs.sparkSession
    ship(spark)
    total = text_bytes(docs, text)
    blocks = max(1, -(-total // block_bytes))
    buckets = max(1, -(-3 * total // bucket_bytes))
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PARTITION_BYTES)
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    frequent = spark.sparkContext.broadcast(_frequent(own, total, buckets, window, mini))  # FREQUENT numbers at most
    named = own.where("doc_id IS NOT NULL")
    dealt = named.select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"), "doc_id", "text").repartition(width, "block")

    def cut(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        block = _Block(_one(table["doc_id"]), _one(table["text"]), window, mini, buckets, frequent.value)
        rows = list(block.packed())
        number = table["block"][0].as_py()
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "block": pa.array([number] * len(rows), pa.int64()), "n": pa.array([r[1] for r in rows], pa.int64()), "blob": pa.array([r[2] for r in rows], pa.binary())})

    strings = dealt.groupBy("block").applyInArrow(cut, "bucket long, block long, n long, blob binary")
    sorted_strings = strings.repartition(width, "bucket").sortWithinPartitions("bucket")
    answers = sorted_strings.mapInArrow(lambda batches: _count_buckets(batches, window, 4 * bucket_bytes), "block long, bucket long, bits binary")

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(_one(left["doc_id"]), _one(left["text"]), window, mini, buckets, frequent.value)
        gone = block.removed(dict(zip(right["bucket"].to_pylist(), right["bits"].to_pylist(), strict=True)), window)
        sums = np.concatenate([[0], np.cumsum(gone)])
        offs, body = block.words.joined(~gone)
        data = body.tobytes()
        texts = [data[a : max(a, b - 1)].decode() for a, b in zip(offs[:-1], offs[1:], strict=True)]
        return pa.table(
            {
                "doc_id": _one(left["doc_id"]).take(pa.array(block.order)),
                "n_words": pa.array(block.words.counts, pa.int64()),
                "n_removed": pa.array(sums[block.words.offs[1:]] - sums[block.words.offs[:-1]], pa.int64()),
                "kept_text": pa.array(texts, pa.string()),
            }
        )

    row = "doc_id long, n_words long, n_removed long, kept_text string"
    found = dealt.groupBy("block").cogroup(answers.repartition(width, "block").groupBy("block")).applyInArrow(keep, row)

    def whole(texts: pa.Array, _) -> list:
        words = Words(texts, SPACED)
        offs, body = words.joined()
        data = body.tobytes()
        return [pa.array(words.counts, pa.int64()), pa.array(np.zeros(len(texts), np.int64)), [data[a : max(a, b - 1)].decode() for a, b in zip(offs[:-1], offs[1:], strict=True)]]

    # Rows without an id lose nothing, so they need no exchange.
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    return found.unionByName(map_text(own.where("doc_id IS NULL"), whole, fields, "text", ["doc_id"]))


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (
  SELECT doc_id, i, hash(array_to_string(w[i:i + 12], ' ')) AS h, array_to_string(w[i:i + 12], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
least AS (SELECT h, t, min(doc_id) AS first FROM win GROUP BY h, t),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (h, t) WHERE first < doc_id),
cut AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
