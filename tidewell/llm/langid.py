"""Language identification as inference of a multilingual mixture.

Each language has a model of byte trigrams within words.  A document is a
mixture: each of its words comes from some language, with proportions that
expectation-maximisation estimates.  The languages enter in the order of their
proportions, for as long as the penalised likelihood (BIC) of the set gains;
the prediction is the set's largest language, its score the share of the
document that is in it.  Every language value of the training rows is learned.

The models are fitted on about ``TRAIN_DOCS`` documents of each language,
chosen by a hash of doc_id, whose whole texts count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import read, ship
from .textkernel import Words, _table, map_text, ranges, string_buffers

#: Labelled documents of a language that its model is fitted on, about.
TRAIN_DOCS = 1500
#: Places of the hashed trigram tables, the count added to each, rounds of EM for a set.
SLOTS, ADDED, ROUNDS = 1 << 16, 0.1, 6
#: Likelihoods held at once: of words by languages.
CELLS = 1 << 24
#: Words are runs of a-z (A-Z lower-cased) and everything beyond ASCII.
LETTERS = _table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128, True)
UNDETERMINED = "und"


def _trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(table places of the words' byte trigrams, word of each); a word has a space at either end."""
    offs, data = string_buffers(pc.binary_join_element_wise(" ", words, " ", "") if len(words) else words)
    n = np.maximum(np.diff(offs) - 2, 0)
    at = ranges(offs[:-1], n)
    key = data[at].astype(np.uint32) * 65536 + data[at + 1].astype(np.uint32) * 256 + data[at + 2]
    key = key * np.uint32(2654435761)
    return (key >> np.uint32(16)) & np.uint32(SLOTS - 1), np.repeat(np.arange(len(words)), n)


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        """``counts``: languages by slots."""
        self.langs = langs
        total = counts.sum(axis=1, keepdims=True)
        self.logs = np.ascontiguousarray(np.log((counts + ADDED) / (total + ADDED * SLOTS)).T.astype(np.float32))

    def word_logs(self, words: pa.Array) -> np.ndarray:
        """Each word's log-likelihood in each language."""
        slots, owner = _trigrams(words)
        out = np.empty((len(words), len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(owner, self.logs[slots, k], len(words))
        return out

    def mixtures(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(proportions by document and language, whether there was any word).

        Vectorised over documents; every round of EM is a pass over the words.
        """
        langs, n = len(self.langs), words.n_docs
        count = words.counts
        shares = np.zeros((n, langs))
        active = np.flatnonzero(count > 0)
        if not len(active) or not langs:
            return shares, count > 0
        likely = _Likelihoods(self, words)
        full, _ = likely.em(active, np.full((len(active), langs), 1 / langs, np.float32), ROUNDS)
        rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
        best = np.full(len(active), np.inf)
        for size in range(1, langs + 1):
            start = np.where(rank < size, full + np.float32(1e-3), np.float32(0))
            start /= start.sum(axis=1, keepdims=True)
            pi, fit = likely.em(active, start, ROUNDS if size > 1 else 0)
            penalised = -2 * fit + (size - 1) * np.log(np.maximum(count[active], 2)) * 2
            gains = penalised < best - 1e-9
            shares[active[gains]] = pi[gains]
            # Who gains by a language may gain by another one.
            active, full, rank, best = active[gains], full[gains], rank[gains], penalised[gains]
            if not len(active):
                break
        return shares, count > 0


class _Likelihoods:
    """Likelihoods of a chunk's words by language, at most ``CELLS`` of them at a time."""

    def __init__(self, model: Model, words: Words):
        self.model, self.words = model, words
        self.step = max(1, CELLS // len(model.langs))
        self.known = self._of(words.uniq) if len(words.uniq) <= self.step else None

    def _of(self, words: pa.Array) -> np.ndarray:
        logs = self.model.word_logs(words)
        return np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -30)).astype(np.float32)

    def _slices(self, docs: np.ndarray):
        """(first document, cuts between documents, likelihoods) of runs of the documents' words."""
        sizes = self.words.counts[docs]
        at = ranges(self.words.offs[:-1][docs], sizes)
        owner = np.repeat(np.arange(len(docs)), sizes)
        for a in range(0, len(at), self.step):
            codes, own = self.words.codes[at[a : a + self.step]], owner[a : a + self.step]
            if self.known is not None:
                like = self.known[codes]
            else:
                distinct, place = np.unique(codes, return_inverse=True)
                like = self._of(self.words.uniq.take(pa.array(distinct)))[place]
            yield own, np.flatnonzero(np.diff(own, prepend=-1)), like

    def em(self, docs: np.ndarray, pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """(proportions after some rounds, log-likelihoods) of the documents, from the proportions ``pi``."""
        sizes = self.words.counts[docs][:, None].astype(np.float32)
        for _ in range(rounds):
            new = np.zeros_like(pi)
            for own, cuts, like in self._slices(docs):
                part = pi[own] * like
                part /= part.sum(axis=1, keepdims=True)
                new[own[cuts]] += np.add.reduceat(part, cuts, axis=0)
            pi = np.where(pi > 0, np.maximum(new / sizes, np.float32(1e-30)), np.float32(0))
        fit = np.zeros(len(docs))
        for own, cuts, like in self._slices(docs):
            fit[own[cuts]] += np.add.reduceat(np.log((pi[own] * like).sum(axis=1) + 1e-30).astype(np.float64), cuts)
        return pi, fit


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", training=None, train_docs: int = TRAIN_DOCS) -> Model:
    """Learns every language of the rows that have one; ``training`` is a condition on column id that limits them.

    Null and blank texts add nothing, and a language with no other text isn't
    learned.  Repeated rows count each time.  Without any row nothing is
    learned.  The model has SLOTS numbers for each language value.
    """
    ship(docs.sparkSession)
    own = docs.select(docs[doc_id].alias("id"), docs[lang].cast("string").alias("lang"), docs[text].cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    if training is not None:
        own = own.where(training)
    sizes = own.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # A row for each language, where the model on the driver has SLOTS numbers: a small part of it, and no text moves.
    share = F.broadcast(sizes.select("lang", F.least(F.lit(1.0), train_docs / F.col("n")).alias("share")))
    sample = own.select("id", "lang", "text").join(share, "lang").where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) < F.col("share") * (1 << 20))

    def count(batches):
        for batch in batches:
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            for name in sorted(set(langs.tolist())):
                words = Words(batch.column(1).filter(pa.array(langs == name)), LETTERS)
                slots, owner = _trigrams(words.uniq)
                counts = np.bincount(slots, np.bincount(words.codes, minlength=len(words.uniq))[owner] if len(owner) else None, SLOTS).astype(np.int64)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at])], names=["lang", "slot", "n"])

    # Bounded: a row for each language and slot.
    found = sample.select("lang", "text").mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = found.column("lang").to_pylist()
    langs = sorted(set(names))
    counts = np.zeros((len(langs), SLOTS))
    place = {name: i for i, name in enumerate(langs)}
    np.add.at(counts, ([place[n] for n in names], found.column("slot").to_numpy()), found.column("n").to_numpy())
    return Model(langs, counts)


def _has_letter(texts: pa.Array) -> np.ndarray:
    plain = pc.fill_null(pc.match_substring_regex(texts, "[A-Za-z]"), False).to_numpy(zero_copy_only=False).copy()
    for i in np.flatnonzero(~plain):
        t = texts[int(i)].as_py()
        plain[i] = bool(t) and any(c.isalpha() for c in t)
    return plain


def identify(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds lang_pred, score and languages (lang and share, the largest first).

    A text that is null or has no letter is "und" with score 0 and no
    languages, as is every text if no language was learned.  Input columns of
    these names give way.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS numbers a language

    def run(texts, _):
        m = shared.value
        shares, _ = m.mixtures(Words(texts, LETTERS))
        letter = _has_letter(texts)
        preds, scores, sets = [], [], []
        for i in range(len(texts)):
            if letter[i] and m.langs and shares[i].max() > 0:
                order = np.argsort(-shares[i], kind="stable")
                own = [(m.langs[k], float(min(1.0, shares[i][k]))) for k in order if shares[i][k] > 1e-4]
                preds.append(own[0][0])
                scores.append(own[0][1])
                sets.append([{"lang": a, "share": b} for a, b in own])
            else:
                preds.append(UNDETERMINED)
                scores.append(0.0)
                sets.append([])
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        return [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, kind)]

    item = T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])
    return map_text(docs, run, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("languages", T.ArrayType(item))], text, keep)


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs, training=~held_out("id"))
    found = identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.transform("languages", lambda x: x["lang"]).alias("langs"))
