"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated bigram models, of toxic and of ordinary documents, share one
vocabulary and one lowest order: the pooled continuation counts, so an
expression that one class has hardly seen is smoothed alike in both.  All
counts are continuation counts, of distinct preceding words, as in the lower
orders of a trigram model: a passage that many copies repeat counts once.

A document's two log-likelihoods are compared word by word, and two things
leave the comparison.  A language or subject that one class's sample holds more
of moves all its words alike, so each document is measured from its own median
word.  And words seen a few times differ by chance, so a word tells only what
it has beyond ``TELLING``.  The rest is averaged over the document's length; a
logistic curve, fitted on documents that neither model has seen, turns it into
a score.  Its fit allows for wrong labels.

The models are fitted on at most ``MODEL_DOCS`` documents of each class and the
curve on at most ``CURVE_DOCS`` documents; all are chosen by a hash of doc_id,
and their whole texts count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import checkpointed, give_back, read, ship
from .textkernel import ALNUM_LOWER, Words, doc_sums, map_text

#: Bounds of the labelled sample: documents of each class, documents for the curve.
MODEL_DOCS, CURVE_DOCS = 2000, 4000
#: Taken from each pooled count, so that what one predecessor alone shows is left to the order below; pooled counts that weigh
#: as much as that order.
DISCOUNT, BACKED = 1.0, 10.0
#: Log-likelihood difference that a word has to exceed; the excess counts.
TELLING = 0.8
#: (evidence, label, weight) of the curve's made-up documents.
PRIOR = ((0.04, 1.0, 4.0), (0.0, 0.0, 4.0))
#: Words below which a text counts as short; greatest share of toxic documents labelled 0.
SHORT, MOST_WRONG = 50, 0.1
#: What stands before a document's first word, and for words that the sample hasn't.
START, RARE = np.int64(0x5157A27), np.int64(0x0DDB411)


def _shared(counts: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts by class, the same less the discount): of the pooled counts, each class's share.

    Shares are drawn towards ``lower``, those of the order below, by ``BACKED``
    counts: what is rare says little of its own, and nothing is left out.
    """
    both = counts.sum(axis=0)
    share = (counts + BACKED * lower) / (both + BACKED)
    return both * share, np.maximum(both - DISCOUNT, 0) * share


class Model:
    """Two class-conditional models over a shared vocabulary, and the curve that scores them."""

    def __init__(self, words: dict, pairs: dict):
        """``words``: w, t, o, cont; ``pairs``: v, w, t, o — hashes and counts by class, as numpy arrays.

        ``RARE`` stands for all words that the sample hasn't and counts like a word.
        """
        order = np.argsort(words["w"])
        self.vocab = words["w"][order]
        n = len(self.vocab)
        cont = words["cont"][order].astype(float)
        counts = np.stack([words["t"][order], words["o"][order]]).astype(float)
        totals = counts.sum(axis=1, keepdims=True)
        counts, seen = _shared(counts, totals / max(totals.sum(), 1.0))
        seen = seen / np.maximum(counts.sum(axis=1, keepdims=True), 1.0)
        self.uni = seen + (1.0 - seen.sum(axis=1, keepdims=True)) * (cont + 0.5) / (cont.sum() + 0.5 * max(n, 1))
        self.rare = int(self._at(np.array([RARE]))[0])
        v, w = np.where(pairs["v"] == START, n, self._at(pairs["v"])), self._at(pairs["w"])
        both = np.stack([pairs["t"], pairs["o"]]).astype(float)
        # What the two words say of the class by themselves: the history's class shares times the word's likelihoods.
        seen = np.stack([np.bincount(v, x, n + 1) for x in both])
        prior = seen.sum(axis=1, keepdims=True) / max(seen.sum(), 1.0)
        lower = ((seen + BACKED * prior) / (seen.sum(axis=0) + BACKED))[:, v] * self.uni[:, w]
        both, kept = _shared(both, lower / lower.sum(axis=0))
        history = np.stack([np.bincount(v, x, n + 1) for x in both])
        kept = kept / np.maximum(history[:, v], 1e-9)
        self.back = np.stack([1.0 - np.bincount(v, x, n + 1) for x in kept])
        own = kept.any(axis=0)  # without the bigrams that the discount leaves nothing
        keys = (v * n + w)[own]
        order = np.argsort(keys)
        self.keys, self.kept = keys[order], kept[:, own][:, order]
        self.curve = np.zeros(2)

    def _at(self, hashes: np.ndarray) -> np.ndarray:
        n = len(self.vocab)
        if not n:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocab, hashes), n - 1)
        rare = min(int(np.searchsorted(self.vocab, RARE)), n - 1)
        return np.where(self.vocab[at] == hashes, at, rare).astype(np.int64)

    def differences(self, words: Words) -> np.ndarray:
        """Each word's log-likelihood as toxic less that as ordinary, given the word before it."""
        n, count = len(self.vocab), words.counts
        if not n:
            return np.zeros(len(words))
        w = self._at(words.uniq_hash().view(np.int64))[words.codes]
        v = np.empty(len(w), np.int64)
        v[1:] = w[:-1]
        v[words.offs[:-1][count > 0]] = n
        key = v * n + w
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        p = self.back[:, v] * self.uni[:, w]
        if len(self.keys):
            p += np.where(self.keys[at] == key, self.kept[:, at], 0.0)
        return np.log(p[0]) - np.log(p[1])

    def measure(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(mean of what each document's words exceed its median word and TELLING by, words); 0 without words."""
        diff, count = self.differences(words), words.counts
        some = count > 0
        ranked = diff[np.lexsort((diff, words.doc_of()))]
        first, middle = words.offs[:-1][some], np.zeros(len(count))
        middle[some] = (ranked[first + (count[some] - 1) // 2] + ranked[first + count[some] // 2]) / 2
        beyond = np.maximum(diff - np.repeat(middle, count) - TELLING, 0.0)
        return doc_sums(beyond, words.offs) / np.maximum(count, 1), count

    @staticmethod
    def _evidence(mean: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The difference per word, drawn towards 0 in short texts."""
        return mean * np.sqrt(count / (count + SHORT))

    def fit_curve(self, mean: np.ndarray, count: np.ndarray, toxic: np.ndarray) -> None:
        """A logistic curve through labels of which some are wrong.

        Expectation-maximisation: rates of wrong labels in either class give
        each document a probability, to which Newton's method fits the curve.
        ``PRIOR`` adds a few made-up documents, which steady the curve where
        labels are few and vanish among thousands.
        """
        x, label = self._evidence(mean, count), toxic > 0
        made = np.array(PRIOR)
        scale = max(float(np.concatenate([x, made[:, 0]]).std()), 1e-9)
        z = np.stack([np.ones(len(x) + len(made)), np.concatenate([x, made[:, 0]]) / scale], axis=1)
        weight = np.concatenate([np.ones(len(x)), made[:, 2]])
        true = np.where(label, 0.9, 0.02)
        ridge, b = np.diag([1e-3, 1e-2]), np.zeros(2)
        for _ in range(100):
            y = np.concatenate([true, made[:, 1]])
            for _ in range(50):
                p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
                step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (weight * (y - p)) - ridge @ b)
                b = b + np.clip(step, -1, 1)
                if np.abs(step).max() < 1e-8:
                    break
            p = 1 / (1 + np.exp(-np.clip(z[: len(x)] @ b, -30, 30)))
            wrong_one = ((1 - true) * label).sum() / max((1 - true).sum(), 1e-9)
            wrong_zero = min(MOST_WRONG, (true * ~label).sum() / max(true.sum(), 1e-9))
            new = np.where(label, p * (1 - wrong_zero) / (p * (1 - wrong_zero) + (1 - p) * wrong_one + 1e-300), p * wrong_zero / (p * wrong_zero + (1 - p) * (1 - wrong_one) + 1e-300))
            moved, true = np.abs(new - true).max(initial=0), new
            if moved < 1e-7:
                break
        self.curve = np.array([b[0], max(b[1], 0.0) / scale])

    def scores(self, words: Words) -> np.ndarray:
        x = self.curve[0] + self.curve[1] * self._evidence(*self.measure(words))
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _trigrams(texts: pa.Array, toxic: np.ndarray) -> pa.Table:
    """Distinct (u, v, w, class) of some texts; u and v are START before the beginning."""
    words = Words(texts, ALNUM_LOWER)
    w = words.hashes().view(np.int64)
    first = words.offs[:-1][words.counts > 0]
    v, u = np.empty(len(w), np.int64), np.empty(len(w), np.int64)
    v[1:] = w[:-1]
    v[first] = START
    u[1:] = v[:-1]
    u[first] = START
    t = np.repeat(toxic.astype(np.int64), words.counts)
    order = np.lexsort((t, w, v, u))
    new = np.ones(len(w), bool)
    for i, x in enumerate((u, v, w, t)):
        y = x[order]
        new[1:] = (y[1:] != y[:-1]) if i == 0 else new[1:] | (y[1:] != y[:-1])
    at = order[new]
    return pa.table({"u": u[at], "v": v[at], "w": w[at], "t": t[at]})


def _types(trigrams: DataFrame) -> tuple[dict, dict]:
    """Continuation counts of all words and bigrams of the sample by class."""
    toxic, ordinary = F.sum("t").cast("int").alias("t"), F.sum(1 - F.col("t")).cast("int").alias("o")
    pairs = checkpointed(trigrams.distinct().groupBy("v", "w").agg(toxic, ordinary))
    words = _columns(pairs.groupBy("w").agg(F.sum((F.col("t") > 0).cast("long")).alias("t"), F.sum((F.col("o") > 0).cast("long")).alias("o"), F.count(F.lit(1)).alias("cont")))
    if len(words["w"]):
        # A word that the sample hasn't is left to the lowest order.
        words = {c: np.append(x, RARE if c == "w" else np.int64(0)) for c, x in words.items()}
    return words, _columns(pairs)


def _columns(df: DataFrame) -> dict:
    table = df.toArrow()
    return {c: table.column(c).to_numpy() for c in table.column_names}


def labelled(labels: DataFrame, *, label: str = "toxic", doc_id: str = "doc_id") -> DataFrame:
    """(id, y, part, rank): usable labels; part 0 is for the curve, others for the models.

    Labels other than 0 and 1, null ids and ids with contradicting labels are
    left out.
    """
    ids = labels.select(labels[doc_id].alias("id"), labels[label].cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    ids = ids.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").drop("other")
    mixed = F.xxhash64("id", F.lit(11))
    return ids.withColumn("part", F.pmod(mixed, F.lit(4))).withColumn("rank", F.xxhash64("id", F.lit(17)))


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", training=None, model_docs: int = MODEL_DOCS, curve_docs: int = CURVE_DOCS) -> Model:
    """The fitted model.  ``training`` is a condition on column id; other labels aren't looked at.

    Null and blank texts add nothing.  A document repeated under one id counts
    as often as it stands there, though its bigrams count once; ties in the
    choice of the sample go by id.  Without labels of both classes, or without
    documents, no curve is fitted (``curve`` is zero) and every score is 0.5.
    """
    ship(docs.sparkSession)
    own = labelled(labels, label=label, doc_id=doc_id)
    if training is not None:
        own = own.where(training)
    own = own.join(docs.select(docs[doc_id].alias("id")).distinct(), "id", "left_semi")
    own = checkpointed(own)
    sizes = {(r["y"], r["curve"]): r["n"] for r in own.groupBy("y", (F.col("part") == 0).alias("curve")).agg(F.count(F.lit(1)).alias("n")).collect()}
    each = model_docs if (0, False) in sizes and (1, False) in sizes else 0
    chosen = own.where("part <> 0 AND y = 1").orderBy("rank", "id").limit(each).unionByName(own.where("part <> 0 AND y = 0").orderBy("rank", "id").limit(each))
    chosen = chosen.unionByName(own.where("part = 0").orderBy("rank", "id").limit(curve_docs))
    texts = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text"))
    sample = checkpointed(texts.join(F.broadcast(chosen.select("id", "y", "part")), "id").select("text", "y", "part"))

    def count(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _trigrams(batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)).to_batches()

    trigrams = sample.where("part <> 0").select("text", "y").mapInArrow(count, "u long, v long, w long, t long")
    model = Model(*_types(trigrams))
    give_back()

    def measure(texts, _):
        mean, n = model.measure(Words(texts, ALNUM_LOWER))
        return [pa.array(mean), pa.array(n, pa.int64())]

    seen = _columns(map_text(sample.where("part = 0"), measure, [T.StructField("mean", T.DoubleType()), T.StructField("n", T.LongType())], "text", ["y"]))
    if len(seen["y"]):
        model.fit_curve(seen["mean"], seen["n"], seen["y"])
    return model


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """Adds ``out``, 0 to 1.  Null and blank texts have the score of no evidence; a column named ``out`` gives way."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample's bound

    def run(texts, _):
        return [pa.array(shared.value.scores(Words(texts, ALNUM_LOWER)))]

    return map_text(docs, run, [T.StructField(out, T.DoubleType())], text, keep)


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"), training=~held_out("id"))
    found = score(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
