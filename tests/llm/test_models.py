"""Toxicity, languages and LM scores: brute-force arithmetic and held-out accuracy."""

import math
import random
import re
import statistics
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewell.llm import langid, lmscore, registry, toxicity
from tidewell.llm.textkernel import ALNUM_LOWER, Words
from tests.llm.helpers import awkward, frame, passage

BAD = ["vile", "rotten", "awful", "nasty"]


def labelled_corpus(spark, n=500):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        w = passage(4000 + i, r.randint(20, 120)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(2, len(w) // 20)):
                w.insert(r.randrange(len(w)), r.choice(BAD))
        rows.append((100 + i, " ".join(w)))
        if i % 10 < 8:
            labels.append((100 + i, 1, int(toxic)))
    labels += [(100, 1, 0), (None, 1, 1), (101, 1, None), (9999, 1, 1)]
    return frame(spark, rows + awkward()), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_toxicity_is_found_on_held_out_documents(spark):
    docs, labels, rows = labelled_corpus(spark, 1500)
    model = toxicity.fit(docs, labels, training=~toxicity.held_out("id"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    bad = {i for i, t in rows if any(w in t for w in BAD)}
    assert sum((got[i] >= 0.5) == (i in bad) for i in held) >= 0.9 * len(held)
    assert all(0 <= s <= 1 for s in got.values()) and got[2] == got[3] < 0.5


def test_scores_do_not_depend_on_neighbours(spark):
    docs, labels, rows = labelled_corpus(spark, 120)
    model = toxicity.fit(docs, labels)
    texts = [t for _, t in rows[:20]]
    together = model.scores(Words(pa.array(texts), ALNUM_LOWER))
    alone = [model.scores(Words(pa.array([t]), ALNUM_LOWER))[0] for t in texts]
    assert list(together) == alone


def test_kneser_ney_probabilities_sum_to_one(spark):
    docs, labels, _ = labelled_corpus(spark, 200)
    model = toxicity.fit(docs, labels)
    for c in (0, 1):
        assert abs(model.uni[c].sum() - 1) < 1e-9
    n = len(model.vocab)
    for v in (0, n // 2, n):
        for c in (0, 1):
            own = (model.keys // n) == v
            assert abs(model.kept[c][own].sum() + model.back[c][v] - 1) < 1e-9


def slow_toxicity(rows, label, texts):
    """Per-word differences by dictionaries: two Kneser-Ney models with shared lowest order, rare shares drawn towards it."""
    marked = lambda t: ["<s>", "<s>"] + tokens(t)
    grams = {(*q[k : k + 3], label[i]) for i, t in rows if i in label for q in [marked(t)] for k in range(len(q) - 2)}
    pair, word = ({0: Counter(), 1: Counter()} for _ in range(2))
    for _, v, w, y in grams:
        pair[y][v, w] += 1
    for y in (0, 1):
        for _, w in pair[y]:
            word[y][w] += 1
    cont = Counter(w for _, w in set(pair[0]) | set(pair[1]))
    cont["<rare>"] += 0
    total = {y: sum(word[y].values()) for y in (0, 1)}

    def split(counts, lower):
        both = sum(counts)
        share = [(c + toxicity.BACKED * x) / (both + toxicity.BACKED) for c, x in zip(counts, lower, strict=True)]
        return [both * x for x in share], [max(both - toxicity.DISCOUNT, 0) * x for x in share]

    prior = [total[y] / sum(total.values()) for y in (0, 1)]
    parts = {w: split([word[0][w], word[1][w]], prior) for w in cont}
    mass = [sum(p[0][y] for p in parts.values()) for y in (0, 1)]
    rest = [1 - sum(p[1][y] for p in parts.values()) / mass[y] for y in (0, 1)]
    uni = {w: [parts[w][1][y] / mass[y] + rest[y] * (cont[w] + 0.5) / (sum(cont.values()) + 0.5 * len(cont)) for y in (0, 1)] for w in cont}
    seen = {y: Counter() for y in (0, 1)}
    for y in (0, 1):
        for (v, _), c in pair[y].items():
            seen[y][v] += c
    every = [sum(seen[y].values()) for y in (0, 1)]

    def lower(v, w):
        said = [(seen[y][v] + toxicity.BACKED * every[y] / sum(every)) / (seen[0][v] + seen[1][v] + toxicity.BACKED) * uni[w][y] for y in (0, 1)]
        return [x / sum(said) for x in said]

    both = {(v, w): split([pair[0][v, w], pair[1][v, w]], lower(v, w)) for v, w in set(pair[0]) | set(pair[1])}
    history, kept = ({y: Counter() for y in (0, 1)} for _ in range(2))
    for (v, _), (weight, less) in both.items():
        for y in (0, 1):
            history[y][v] += weight[y]
            kept[y][v] += less[y]

    def p(y, v, w):
        h = history[y][v]
        own = both[v, w][1][y] / h if (v, w) in both else 0.0
        return own + (1 - kept[y][v] / h if h else 1.0) * uni[w][y]

    known = lambda w: w if w in cont or w == "<s>" else "<rare>"
    return [[math.log(p(1, known(v), known(w)) / p(0, known(v), known(w))) for v, w in zip(q[1:], q[2:], strict=False)] for q in map(marked, texts)]


def test_kneser_ney_by_brute_force(spark):
    docs, labels, rows = labelled_corpus(spark, 120)
    part = {r.id: (r.y, r.part) for r in toxicity.labelled(labels).collect()}
    model = toxicity.fit(docs, labels)
    texts = [t for _, t in rows[:30]] + ["Vile VILE unseen", "rotten-unseen words", ""]
    words = Words(pa.array(texts), ALNUM_LOWER)
    everything = [(i, t) for i, t in rows + awkward() if i is not None]
    want = slow_toxicity(everything, {i: y for i, (y, p) in part.items() if p}, texts)
    got, (mean, count) = model.differences(words), model.measure(words)
    for i, slow in enumerate(want):
        assert list(got[words.offs[i] : words.offs[i + 1]]) == pytest.approx(slow, abs=1e-9)
        middle = statistics.median(slow) if slow else 0
        beyond = sum(max(d - middle - toxicity.TELLING, 0) for d in slow) / max(len(slow), 1)
        assert count[i] == len(slow) and mean[i] == pytest.approx(beyond, abs=1e-9)


def test_every_word_and_bigram_of_the_sample_is_in_the_toxicity_model(spark):
    rows = [(i, passage(7000 + i, 30) + (f" vile{i % 3}" if i % 2 else f" mild{i % 3}")) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(frame(spark, rows), labels)
    once = Words(pa.array(["vile0 vile1 vile2 mild0 mild1 mild2"]), ALNUM_LOWER)
    assert len(set(model._at(once.uniq_hash().view("int64"))) - {model.rare}) == 6
    bad, good = (Words(pa.array([t]), ALNUM_LOWER) for t in ("vile0 vile1 vile2", "mild0 mild1 mild2"))
    assert model.differences(bad).mean() > 0.5 > -0.5 > model.differences(good).mean()


def test_a_language_that_one_class_holds_more_of_does_not_mark_its_documents(spark):
    r = random.Random(4)
    tongue = lambda lang, n: [w + str(r.randrange(9)) for w in speech(lang, n, r).split()]
    rows, labels = [], []
    for i in range(900):
        lang, toxic = ("aa", i % 3 == 0) if i % 2 else ("bb", i % 12 == 0)
        w = tongue(lang, r.randint(60, 150))
        if toxic:
            for _ in range(len(w) // 15):
                w.insert(r.randrange(len(w)), f"{lang}vile{r.randrange(4)}")
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), training=~toxicity.held_out("id"))
    y, held = dict(labels), [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    got = dict(zip(held, model.scores(Words(pa.array([rows[i][1] for i in held]), ALNUM_LOWER)), strict=True))
    assert sum((got[i] >= 0.5) == y[i] for i in held) >= 0.97 * len(held)


def test_toxicity_on_held_out_labels_of_each_language(spark):
    """The test tables' labels, 10 % of others passed over: recall where the language has ten toxic documents or more."""
    folder = "/root/testdata/sf0.1"
    found = registry.queries()["op7_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    lang = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = found.where("held_out").join(labels, "doc_id").join(lang, "doc_id").collect()
    clean = sorted(r.score for r in got if not r.toxic)
    at = clean[int(0.9 * len(clean))]
    toxic = [r for r in got if r.toxic]
    assert sum(r.score > at for r in toxic) >= 0.9 * len(toxic)
    for one in {r.lang for r in toxic}:
        own = [r.score > at for r in toxic if r.lang == one]
        assert len(own) < 5 or sum(own) >= 0.85 * len(own), one
    assert sum(r.score < 0.5 for r in got if not r.toxic) >= 0.99 * len(clean)


def test_toxicity_without_labels_or_documents(spark):
    docs, labels, _ = labelled_corpus(spark, 20)
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(frame(spark, []), toxicity.fit(frame(spark, []), labels)).count() == 0


def test_toxicity_query(spark, tiny):
    found = registry.queries()["op7_toxicity"](spark, tiny).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in found)
    assert {r.predicted for r in found} == {0, 1}


TONGUES = {"aa": "ka ri mo tu lena sofi".split(), "bb": "schrat glupf wentz brokt".split(), "cc": "ééla ûmi çora naï".split()}


def speech(lang, n, r):
    return " ".join("".join(r.choice(TONGUES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


def speech_corpus(spark):
    r = random.Random(3)
    rows = [(i, speech(lang, r.randint(3, 60), r), lang) for i, lang in enumerate(random.Random(1).choices(sorted(TONGUES), k=300))]
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "123 --- 4", None), (903, "—…", None), (904, "東京", None), (None, "ka ri", "aa")]
    rows += [(905, speech("aa", 60, r) + " " + speech("bb", 30, r), None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_languages_and_mixtures(spark):
    docs, rows = speech_corpus(spark)
    model = langid.train(docs, training=~langid.held_out("id"))
    got = {r.doc_id: r for r in langid.identify(docs.withColumn("score", F.lit("clash")), model).collect()}
    held = [(i, lang) for i, _, lang in rows[:300] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.98 * len(held)
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und"] * 4 and got[900].score == 0
    assert got[904].lang_pred in TONGUES
    mix = {x.lang: x.share for x in got[905].languages}
    assert set(mix) == {"aa", "bb"} and abs(mix["aa"] - 2 / 3) < 0.08 and got[905].lang_pred == "aa"
    assert abs(got[905].score - mix["aa"]) < 1e-12
    pure = [i for i, t, _ in rows[:300] if len(t.split()) > 20]
    assert sum(len(got[i].languages) == 1 for i in pure) >= 0.97 * len(pure)


def test_likelihood_never_falls_and_penalty_prefers_fewer(spark):
    docs, _ = speech_corpus(spark)
    model = langid.train(docs)
    shares, some = model.mixtures(Words(pa.array([speech("aa", 40, random.Random(5)), None]), langid.LETTERS))
    assert some.tolist() == [True, False] and abs(shares[0].sum() - 1) < 1e-5 and shares[1].sum() == 0
    assert (shares[0] > 0).sum() == 1


def slow_mixture(model, text):
    """One document's proportions by plain loops, for as long as the penalised likelihood gains."""
    import numpy as np

    words = Words(pa.array([text]), langid.LETTERS)
    logs = model.word_logs(words.uniq)[words.codes].astype(float)
    like = [[math.exp(max(x - max(row), -30)) for x in row] for row in logs]

    def em(pi, rounds):
        for _ in range(rounds):
            new = [0.0] * len(pi)
            for row in like:
                total = sum(p * x for p, x in zip(pi, row, strict=True))
                for k, (p, x) in enumerate(zip(pi, row, strict=True)):
                    new[k] += p * x / total
            pi = [x / len(like) for x in new]
        return pi, sum(math.log(sum(p * x for p, x in zip(pi, row, strict=True))) for row in like)

    langs = len(model.langs)
    full, _ = em([1 / langs] * langs, langid.ROUNDS)
    order = sorted(range(langs), key=lambda k: -full[k])
    best, chosen = math.inf, None
    for size in range(1, langs + 1):
        start = [full[k] + 1e-3 if k in order[:size] else 0.0 for k in range(langs)]
        pi, fit = em([x / sum(start) for x in start], langid.ROUNDS if size > 1 else 0)
        penalised = -2 * fit + (size - 1) * math.log(max(len(like), 2)) * 2
        if penalised >= best - 1e-9:
            break
        best, chosen = penalised, pi
    return np.array(chosen)


@pytest.mark.parametrize("cells", [langid.CELLS, 7])
def test_mixtures_by_brute_force(spark, monkeypatch, cells):
    docs, rows = speech_corpus(spark)
    model = langid.train(docs)
    monkeypatch.setattr(langid, "CELLS", cells)
    r = random.Random(12)
    texts = [t for _, t, _ in rows[:25]] + [speech("aa", 30, r) + " " + speech("bb", 25, r) + " " + speech("cc", 20, r), "", None, "ka"]
    shares, some = model.mixtures(Words(pa.array(texts), langid.LETTERS))
    for t, own, any_ in zip(texts, shares, some, strict=True):
        assert any_ == bool(t)
        if t:
            assert abs(own - slow_mixture(model, t)).max() < 1e-3


def test_every_language_is_learned_and_sets_are_as_large_as_the_text_says(spark):
    r = random.Random(5)
    made = {f"l{k:03d}": ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)] for k in range(260)}
    say = lambda lang, n: " ".join(r.choice(made[lang]) for _ in range(n))
    rows = [(i, say(lang, 40), lang) for i, lang in enumerate(sorted(made) * 2)]
    mixed = [(5000, " ".join(say(f"l{k:03d}", 60) for k in range(7)), None)]
    docs = spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string")
    model = langid.train(docs, training=F.col("id") < 260)
    assert len(model.langs) == 260
    got = {x.doc_id: x for x in langid.identify(docs.where("doc_id >= 260"), model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if i >= 260)
    assert {x.lang for x in got[5000].languages if x.share > 0.02} == {f"l{k:03d}" for k in range(7)}


def test_language_query_by_brute_force(spark, tiny):
    """Counts, held-out rows and predictions of the registered query, from the tables alone."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    found = {r.doc_id: r for r in registry.queries()["op5_langid"](spark, tiny).collect()}
    model = langid.train(docs, training=~langid.held_out("id"))
    for r in docs.where("length(text) < 3000").limit(40).collect():
        got = found[r.doc_id]
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        want = slow_mixture(model, r.text)
        assert got.lang_pred == model.langs[int(want.argmax())] and abs(got.score - want.max()) < 1e-3


def test_no_languages_learned(spark):
    docs, rows = speech_corpus(spark)
    model = langid.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_language_query_accuracy(spark, tiny):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    found = registry.queries()["op5_langid"](spark, tiny).collect()
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def tokens(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_losses(rows, target):
    pairs, uni, hist = ([Counter(), Counter()] for _ in range(3))
    for i, t in rows:
        q = ["<s>"] + tokens(t)
        for m in (0, 1) if i in target else (1,):
            for v, w in zip(q, q[1:]):
                pairs[m][v, w] += 1
                uni[m][w] += 1
                hist[m][v] += 1
    held = [sum(uni[m].values()) for m in (0, 1)]
    scale = [1, held[0] / max(held[1], 1)]
    out = {}
    for i, t in rows:
        q = ["<s>"] + tokens(t)
        loss = [0.0, 0.0]
        for m in (0, 1):
            for v, w in zip(q, q[1:]):
                word = (scale[m] * uni[m][w] + lmscore.WORD_BACKED * uni[1][w] / (held[1] + 1)) / (held[0] + lmscore.WORD_BACKED)
                loss[m] -= math.log((scale[m] * pairs[m][v, w] + lmscore.PAIR_BACKED * word) / (scale[m] * hist[m][v] + lmscore.PAIR_BACKED))
        n = len(q) - 1
        out[i, t] = (n, loss[0] / n if n else None, loss[1] / n if n else None)
    return out


def many_words():
    rows = [(20 + i, " ".join(f"w{(i * 97 + k * (1 + i % 5)) % 21_000}" for k in range(150)) + " " + passage(i % 20, 20)) for i in range(300)]
    return rows + [r for r in awkward() if r[0] is not None and r[0] != 11]


def agree(found, want):
    for r in found:
        n, a, b = want[r.doc_id, r.text]
        assert r.n_tokens == n
        if n:
            assert abs(r.target_loss - a) < 1e-9 and abs(r.background_loss - b) < 1e-9 and abs(r.score - (a - b)) < 1e-9
        else:
            assert r.score is None and r.target_loss is None


@pytest.mark.parametrize("held", [lmscore.HELD, 500])
@pytest.mark.parametrize("fused", [True, False])
def test_losses_by_brute_force(spark, monkeypatch, held, fused):
    """Every word and bigram counts, in one exchange and in two."""
    monkeypatch.setattr(lmscore, "HELD", held)
    monkeypatch.setattr(lmscore, "BROADCAST_IDS", 10 if held == 500 else 1000)
    rows = many_words()
    docs, target = frame(spark, rows), {i for i, _ in rows if i % 4 == 0}
    ids = spark.createDataFrame([(i,) for i in target], "id long")
    found = lmscore.score_corpus(docs, ids, keep=["doc_id", "text", "score"]) if fused else lmscore.score(docs, lmscore.fit(docs, ids), keep=["doc_id", "text", "score"])
    found = found.collect()
    assert sorted((r.doc_id, r.text or "") for r in found) == sorted((i, t or "") for i, t in rows)
    agree(found, slow_losses(rows, target))


def test_scores_of_other_documents_and_of_nothing(spark):
    rows = many_words()[:60]
    ids = spark.createDataFrame([(i,) for i, _ in rows if i % 2], "id long")
    model = lmscore.fit(frame(spark, rows), ids)
    strange = lmscore.score(frame(spark, [(1, "neverseen words " + rows[0][1]), (2, None)]), model).collect()
    assert {r.n_tokens for r in strange} == {2 + len(tokens(rows[0][1])), 0}
    assert lmscore.score_corpus(frame(spark, []), ids).count() == 0
    assert lmscore.score(frame(spark, rows[:2]), lmscore.fit(frame(spark, []), ids)).where("score <> 0").count() == 0
    untargeted = lmscore.score_corpus(frame(spark, rows), ids.limit(0)).collect()
    assert all(abs(r.score) < 1e-12 for r in untargeted if r.n_tokens)


def test_background_is_matched_in_size(spark):
    """Target documents that are like all others get no worse a loss for being few."""
    rows = [(i, passage(i % 10, 60)) for i in range(200)]
    ids = spark.createDataFrame([(i,) for i in range(10)], "id long")
    found = lmscore.score_corpus(frame(spark, rows), ids).collect()
    assert max(abs(r.score) for r in found) < 1e-9


def test_probabilities_sum_to_one():
    import numpy as np

    words = Words(pa.array(["a b c a", "", "b b c"]), ALNUM_LOWER)
    keys, counts = lmscore.chunk_counts(words, np.array([1, 1, 0]))
    totals = lmscore.Totals(np.array([4.0, 7.0]), np.array([1.0, 2.0]))

    def chance(words):
        word, _, pair = lmscore.token_keys(words)
        asked = np.unique(np.concatenate([word, pair]))
        known = np.zeros((4, len(asked)), np.int64)
        _, at, place = np.intersect1d(asked, keys, return_indices=True)
        known[:, at] = counts[:, place]
        return np.exp(-lmscore.losses(words, asked, known, totals))

    single = Words(pa.array(list("abcd")), ALNUM_LOWER)  # d stands for all others
    every = Words(pa.array([f"{v} {w}" for v in "abcd" for w in "abcd"]), ALNUM_LOWER)
    first = chance(single)
    assert abs(first.sum(axis=1) - 1).max() < 1e-12
    both = chance(every).reshape(2, 4, 4) / first[:, :, None]
    assert abs(both.sum(axis=2) - 1).max() < 1e-12


def slow_query(folder):
    import duckdb

    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    labels = duckdb.sql(f"SELECT doc_id FROM '{folder}/labels.parquet' WHERE quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = 1").fetchall()
    return slow_losses(rows, {i for (i,) in labels}), dict(rows)


def test_packed_counts():
    import numpy as np

    keys = np.array([0, 5, 2**62, 2**62 + 1], np.uint64)
    counts = np.array([[1, 2, 3, 2**40], [0, 0, 1, 5]])
    k, c = lmscore.unpack(lmscore.pack(keys, counts), 2)
    assert (k == keys).all() and (c == counts).all()


def test_lm_query_by_brute_force(spark, tiny):
    want, texts = slow_query(tiny)
    found = registry.queries()["op8_lmscore"](spark, tiny).collect()
    assert len(found) == len(texts)
    for r in found:
        n, a, b = want[r.doc_id, texts[r.doc_id]]
        assert r.n_tokens == n and (abs(r.score - (a - b)) < 1e-9 if n else r.score is None)


def test_target_documents_score_lower(spark, tiny):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{tiny}/labels.parquet").collect()}
    found = registry.queries()["op8_lmscore"](spark, tiny).collect()
    mean = lambda q: (lambda x: sum(x) / len(x))([r.score for r in found if quality.get(r.doc_id) == q and r.score is not None])
    assert mean(1) < mean(0)
