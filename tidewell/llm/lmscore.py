"""LM scoring by cross-entropy difference.

Two bigram models, of the target documents and of the whole corpus as
background, share one vocabulary, every word of the corpus, and hold every
bigram of it.  They are matched: background counts are scaled to the target's
number of tokens, so both models rest on as much text and are smoothed alike,
and no loss is higher for want of data alone.  Words are smoothed by
``WORD_BACKED`` counts of the corpus's word shares, bigrams by ``PAIR_BACKED``
counts of the model's own words.  A document's score is the mean over its
tokens of target loss less background loss, in nats: low means like the target.

All counts are taken over all documents.  Each chunk of documents sends its
distinct keys (words and bigrams) and their counts to hash ranges, as one
packed, sorted block for each range; a range adds up what it was sent and
answers every block with the corpus's counts of its keys.  So counting and
looking up are one exchange, the model grows with the corpus, and no machine
holds more than a range of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import checkpointed, mix64, read, ship, text_bytes
from .textkernel import ALNUM_LOWER, Words, chunks, doc_sums, string_buffers
from .toxicity import labelled

#: Counts of the order below that smooth a word's and a bigram's.
WORD_BACKED, PAIR_BACKED = 100.0, 2.0
#: Entries that a range gathers before it adds them up.
HELD = 3_000_000
#: Text bytes of a chunk, and for each range of the keys.
CHUNK_BYTES, RANGE_BYTES = 6 << 20, 32 << 20
#: Most target ids that are broadcast; more are joined by a merge of both sides.
BROADCAST_IDS = 1_000_000
#: The low bit of a key: a word, a bigram.
WORD, PAIR = np.uint64(0), np.uint64(1)
#: What stands before a document's first word.
START = np.uint64(0x5157A27 << 1)
KEY_BITS = 63
#: Counts of a key: in the target and the corpus, and as a document's last word in either.
COLUMNS = 4
#: In place of a chunk's number: a range of a model.
MODEL = -1
_ROW = "chunk long, part long, blob binary"


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted uint64 keys and int64 counts: differences, split into byte planes and compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = [x.astype(t).view(np.uint8).reshape(len(keys), -1).T.tobytes() for x, t in ((steps, "<u8"), *[(c, "<i8") for c in counts])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, columns: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(raw) // (8 * (columns + 1))
    parts = [np.ascontiguousarray(raw[8 * n * i : 8 * n * (i + 1)].reshape(8, n).T).view("<u8").ravel() for i in range(columns + 1)]
    return np.cumsum(parts[0], dtype=np.uint64), np.array([p.astype(np.int64) for p in parts[1:]], np.int64).reshape(columns, n)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and their summed counts (columns by keys)."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[:, order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at, axis=1)


def token_keys(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word before, bigram) keys of each token; START before a document's first."""
    # A low bit for the kind, and 63 bits in all.
    base = (words.uniq_hash() >> np.uint64(1)) & ~np.uint64(1)
    w = base[words.codes]
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[words.offs[:-1][words.counts > 0]] = START
    pair = (mix64(v * np.uint64(0x9E3779B97F4A7C15) + w) >> np.uint64(1)) & ~np.uint64(1)
    return w | WORD, v, pair | PAIR


def chunk_counts(words: Words, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys of some documents and their counts; ``target`` tells 1 or 0 for each document."""
    base = (words.uniq_hash() >> np.uint64(1)) & ~np.uint64(1)
    of_token, some = np.repeat(target, words.counts), words.counts > 0
    last, kinds = words.codes[words.offs[1:][some] - 1], len(base)
    single = np.stack([np.bincount(c, x, kinds).astype(np.int64) for c, x in ((words.codes, of_token), (words.codes, None), (last, target[some]), (last, None))])
    used = single[1] > 0
    pairs, n = token_keys(words)[2], np.zeros(len(words), np.int64)
    both = np.stack([of_token.astype(np.int64), n + 1, n, n])
    return merged(np.concatenate([base[used] | WORD, pairs]), np.concatenate([single[:, used], both], axis=1))


@dataclass
class Totals:
    """Tokens and documents with any, of target and corpus."""

    tokens: np.ndarray
    docs: np.ndarray


@dataclass
class Model:
    """The corpus's counts of every word and bigram, as rows of packed ranges, and their totals."""

    counts: DataFrame
    ranges: int
    totals: Totals


def losses(words: Words, keys: np.ndarray, counts: np.ndarray, totals: Totals) -> np.ndarray:
    """Summed losses by model and document; ``counts`` (COLUMNS by keys) are those of the documents' sorted distinct keys."""
    tokens = totals.tokens
    scale = np.array([[1.0], [tokens[0] / max(tokens[1], 1.0)]])  # background counts, matched to the target's
    word, before, pair = token_keys(words)
    at = np.searchsorted(keys, word)
    n = counts[:2, at]
    share = np.maximum(n[1], 1) / (tokens[1] + 1.0)  # words that the corpus hasn't count as one
    of_word = (scale * n + WORD_BACKED * share) / (tokens[0] + WORD_BACKED)
    first = before == START
    known = np.minimum(np.searchsorted(keys, before), max(len(keys) - 1, 0))
    history = np.where(first, totals.docs[:, None], counts[:2, known] - counts[2:, known])
    of_pair = (scale * counts[:2, np.searchsorted(keys, pair)] + PAIR_BACKED * of_word) / (scale * history + PAIR_BACKED)
    return np.stack([doc_sums(x, words.offs) for x in -np.log(of_pair)])


def _texts(blob: bytes) -> tuple[pa.Table, Words]:
    table = pa.ipc.open_stream(blob).read_all().combine_chunks()
    return table, Words(table.column("text").chunk(0), ALNUM_LOWER)


def _store(source: DataFrame) -> DataFrame:
    """(chunk, blob, sums): the rows in numbered, packed chunks of bounded text, written once.

    What is sent and what is answered must agree on the numbers, so these stay
    whatever is computed again.  ``sums`` are a chunk's totals.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def pack_rows() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            words = Words(table.column("text").chunk(0), ALNUM_LOWER)
            y, n = table.column("y").to_numpy().astype(np.int64), words.counts
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
                out.write_table(table)
            sums = [int(x) for x in ((n * y).sum(), n.sum(), ((n > 0) * y).sum(), (n > 0).sum())]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()), *[pa.array([x], pa.int64()) for x in sums]], names=["chunk", "blob", "t0", "t1", "d0", "d1"])

        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                offs, _ = string_buffers(part.column("text"))
                own = int(offs[-1] - offs[0])
                if held and size + own > CHUNK_BYTES:
                    yield pack_rows()
                    number, held, size = number + 1, [], 0
                held.append(part)
                size += own
        if held:
            yield pack_rows()

    return checkpointed(source.mapInArrow(store, "chunk long, blob binary, t0 long, t1 long, d0 long, d1 long"))


def _totals(stored: DataFrame) -> Totals:
    row = stored.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("t0", "t1", "d0", "d1")]).first()
    return Totals(np.array([row["t0"], row["t1"]], float), np.array([row["d0"], row["d1"]], float))


def _row(chunk: list, part: list, blob: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(part, pa.int64()), pa.array(blob, pa.binary())], names=["chunk", "part", "blob"])


def _sent(stored: DataFrame, ranges: int, counted: bool) -> DataFrame:
    """Each chunk's distinct keys by range, with their counts in target and corpus, or with zeros."""
    width = -(-(1 << KEY_BITS) // ranges)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                table, words = _texts(blob.as_py())
                keys, counts = chunk_counts(words, table.column("y").to_numpy().astype(np.int64))
                if not counted:
                    counts = np.zeros_like(counts)
                part = (keys // np.uint64(width)).astype(np.int64)
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(keys)]
                spans = [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]
                yield _row([chunk] * len(spans), [int(part[a]) for a, _ in spans], [pack(keys[a:b], counts[:, a:b]) for a, b in spans])

    return stored.select("chunk", "blob").mapInArrow(send, _ROW)


def _answered(sent: DataFrame, parts: int, modelled: bool = False) -> DataFrame:
    """What each range says: the summed counts of every block's keys, or of all its keys if ``modelled``.

    Blocks stay packed until their range is complete, and what is added up
    melts as it grows, so a task holds one range.
    """

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, held = None, [], []

        def total():
            return merged(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held], axis=1))

        def done():
            keys, counts = total()
            if modelled:
                yield _row([MODEL], [now], [pack(keys, counts)])
                return
            for chunk, blob in asked:
                own, _ = unpack(blob, COLUMNS)
                yield _row([chunk], [now], [pack(np.zeros(len(own), np.uint64), counts[:, np.searchsorted(keys, own)])])

        for batch in batches:
            for chunk, part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if now is not None and part != now:
                    yield from done()
                    asked, held = [], []
                now, blob = part, blob.as_py()
                held.append(unpack(blob, COLUMNS))
                if chunk != MODEL:
                    asked.append((chunk, blob))
                if sum(len(k) for k, _ in held) > HELD:
                    held = [total()]
        if held:
            yield from done()

    return sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(answer, _ROW)


def _finished(stored: DataFrame, answered: DataFrame, parts: int, totals: Totals, kept: list[T.StructField]) -> DataFrame:
    fields = [T.StructField("n_tokens", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("target_loss", "background_loss", "score")]]
    names = [f.name for f in (*kept, *fields)]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, answers = None, []

        def done() -> pa.RecordBatch:
            table, words = _texts(now)
            word, _, pair = token_keys(words)
            keys, n = np.unique(np.concatenate([word, pair])), words.counts
            counts = np.concatenate([np.zeros((COLUMNS, 0), np.int64), *answers], axis=1)
            mean = losses(words, keys, counts, totals) / np.maximum(n, 1)
            none = n == 0
            arrays = [table.column(f"k{i}").combine_chunks() for i in range(len(kept))]
            arrays += [pa.array(n, pa.int64()), pa.array(mean[0], mask=none), pa.array(mean[1], mask=none), pa.array(mean[0] - mean[1], mask=none)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for part, blob in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if part < 0:  # a chunk comes before the answers to it
                    if now is not None:
                        yield done()
                    now, answers = blob.as_py(), []
                else:
                    answers.append(unpack(blob.as_py(), COLUMNS)[1])
        if now is not None:
            yield done()

    both = answered.unionByName(stored.select("chunk", F.lit(-1).cast("long").alias("part"), "blob"))
    return both.repartition(parts, "chunk").sortWithinPartitions("chunk", "part").mapInArrow(finish, T.StructType([*kept, *fields]))


def _scale(docs: DataFrame, text: str) -> tuple[int, int]:
    """(ranges of the keys, partitions of an exchange), both growing with the text."""
    own = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(64, own, text_bytes(docs, text) // RANGE_BYTES)
    return ranges, max(own, ranges // 2)


def _marked(docs: DataFrame, target_ids: DataFrame, text: str, doc_id: str, kept: list[str]) -> DataFrame:
    own = docs.select(docs[text].cast("string").alias("text"), docs[doc_id].alias("id"), *[docs[c].alias(f"k{i}") for i, c in enumerate(kept)])
    target = target_ids.select("id", F.lit(1).alias("y"))
    target = F.broadcast(target) if target_ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else target.hint("merge")
    return own.join(target, "id", "left").withColumn("y", F.coalesce("y", F.lit(0))).drop("id")


RESULTS = ("n_tokens", "target_loss", "background_loss", "score")


def _kept(docs: DataFrame, keep: list[str] | None) -> list[T.StructField]:
    return [docs.schema[c] for c in (docs.columns if keep is None else keep) if c not in RESULTS]


def fit(docs: DataFrame, target_ids: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> Model:
    """The two models, to score any documents; ``target_ids`` has the target documents' ids in column id, once each.

    Null and blank texts add nothing, repeated rows count each time, rows
    without an id are background alone.  Without a target, or without
    documents, both models are the same and every score is 0.
    """
    ship(docs.sparkSession)
    ranges, parts = _scale(docs, text)
    stored = _store(_marked(docs, target_ids, text, doc_id, []))
    return Model(checkpointed(_answered(_sent(stored, ranges, True), parts, modelled=True)), ranges, _totals(stored))


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds n_tokens, target_loss, background_loss (nats a token) and score, their difference.

    Null and blank texts have no tokens and null losses and score.  Input
    columns of these names give way.
    """
    ship(docs.sparkSession)
    kept, (_, parts) = _kept(docs, keep), _scale(docs, text)
    stored = _store(docs.select(docs[text].cast("string").alias("text"), F.lit(0).alias("y"), *[docs[f.name].alias(f"k{i}") for i, f in enumerate(kept)]))
    answered = _answered(_sent(stored, model.ranges, False).unionByName(model.counts), parts)
    return _finished(stored, answered, parts, model.totals, kept)


def score_corpus(docs: DataFrame, target_ids: DataFrame, *, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``score(docs, fit(docs, target_ids))`` in one exchange: what a chunk counts is what it asks for."""
    ship(docs.sparkSession)
    kept, (ranges, parts) = _kept(docs, keep), _scale(docs, text)
    stored = _store(_marked(docs, target_ids, text, doc_id, [f.name for f in kept]))
    return _finished(stored, _answered(_sent(stored, ranges, True), parts), parts, _totals(stored), kept)


def op8_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    target = labelled(read(spark, sf_dir, "labels"), label="quality").where("y = 1").select("id")
    return score_corpus(docs, target, keep=["doc_id"])
