"""Personal data: fixed patterns, and spans learned by weak supervision.

Emails, IP addresses, card and phone numbers are found by their patterns and
always stay.  Further kinds (names, national ids, IBANs, secrets) begin as
candidates of a shape alone, such as two capitalised words, on which labelers
vote for, against or not at all: a regex labeler on the shape and what touches
it, a gazetteer labeler (titles' and first names, places and calendar words,
countries, issuers, areas), a context labeler on whole words around, and a
checksum-or-entropy labeler.  Counts of vote patterns over all documents go
through expectation-maximisation, which estimates each labeler's reliability
for each kind and so a probability for each pattern; with these as soft labels
a logistic span classifier is trained on features of the span and its
surroundings, and it decides on every candidate.

Only counts by (kind, votes, features) leave the executors; all three have a
fixed number of values, so their table is bounded whatever the corpus.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import read, ship
from .textkernel import map_text

BASE = ("email", "ip", "card", "phone")
LEARNED = ("iban", "name", "national_id", "secret")
KINDS = BASE + LEARNED

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A failed match from the start of a run of digits fails from within it too, so runs are taken whole.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Words and numbers that labelers know.
_TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora"
_FIRST = frozenset("Anna Carlos David Elena Emma Hans Jean John José Juan Klaus Laura Lucía Maria Marie Mary Michael Paul Peter Pierre Robert Sophie Thomas".split())
_NO_NAMES = frozenset(
    "January February March April May June July August September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday "
    "New North South East West United Great The This That These Those In On At And But For With Street Road Avenue Square Park Lake River Mount Saint "
    "University Museum Hotel Airport Station Court Bank Company Republic Kingdom States City County "
    "License Licence Public General Version Software Foundation Copyright Rights Reserved".split()
)
_IBAN_SIZES = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
_SPECIMENS = frozenset(["078-05-1120", "123-45-6789", "219-09-9999"])
_ISSUERS = re.compile(r"(?:ghp_|gho_|AKIA|ASIA|sk-|sk_live_|xox[abp]-|AIza|glpat-)")
_YES = {
    "iban": "iban|bic|account|konto|compte|cuenta",
    "name": "name|contact|by|from|dear|signed|hello|regards|sincerely|author|von|par|por",
    "national_id": "ssn|social|security|id|identity|taxpayer",
    "secret": "tokens?|secrets?|passw(?:or)?d|passwort|api|keys?|apikey|auth|credentials?",
}
_NO = {
    "iban": "serial|order|model|part",
    "name": "street|avenue|museum|saint|university|river|airport|hotel|city",
    "national_id": "part|model|version|isbn|order|phone|fax",
    "secret": "commit|sha|sha1|sha256|hash|checksum|md5|digest|version|isbn|uuid|iban|account|serial|order|model",
}
_CAPITAL = "[A-ZÀ-Þ][a-zß-ÿ]{2,}"
_CANDIDATES = {
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "name": re.compile(rf"(?<![^\W\d_])(?:(?:{_TITLES})\.? {_CAPITAL}(?: {_CAPITAL})?|{_CAPITAL} {_CAPITAL})(?![^\W\d_])"),
    "national_id": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "secret": re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{20,}"),
}
#: Whether a text can hold a name at all; Arrow's regex engine asks it of whole columns.
_NAMED = rf"(?:{_TITLES})\.? [A-ZÀ-Þ]|{_CAPITAL} [A-ZÀ-Þ]"


def _words(choice: str) -> re.Pattern:
    """Any of the words, whole."""
    return re.compile(rf"(?i)(?<![^\W\d_])(?:{choice})(?![^\W\d_])")


_SAYS_YES, _SAYS_NO = ({kind: _words(choice) for kind, choice in said.items()} for said in (_YES, _NO))
_TITLED = re.compile(rf"(?:{_TITLES})\.? ")
_MORE, _EARLIER = re.compile(rf" {_CAPITAL}"), re.compile(rf"{_CAPITAL} $")
_HEX = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_PARTS = re.compile(r"(?:^|[-_])[A-Za-z]{3,}(?=[-_]|$)")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Characters before and after a span that context labelers and features see.
AROUND = 24
LABELERS = 4
FEATURES = 11


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' spans: leftmost, non-overlapping within a kind, in code points."""
    out = []
    last = 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                last = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def _iban(s: str) -> bool:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _vote(yes: bool, no: bool = False) -> str:
    return "+" if yes else "-" if no else "0"


def votes(kind: str, span: str, before: str, after: str) -> str:
    """One character a labeler, in order shape, gazetteer, context, check: + for, - against, 0 neither."""
    plain = span.replace(" ", "")
    if kind == "secret":
        kinds = sum(any(map(test, span)) for test in (str.isupper, str.islower, str.isdigit))
        hexadecimal = bool(_HEX.fullmatch(span))  # a digest as well as a secret
        worded = len(_PARTS.findall(span)) > 1
        shape = _vote(kinds == 3, sum(c.isdigit() for c in span) < 3 or worded)
        gazetteer = _vote(bool(_ISSUERS.match(span)), bool(_UUID.search(span) or _CANDIDATES["iban"].fullmatch(span)))
        check = _vote(_entropy(span) >= 3.5 and not hexadecimal and not worded, _entropy(span) < 3.2)
    elif kind == "name":
        words = _TITLED.sub("", span).split(" ")
        shape = _vote(bool(_TITLED.match(span)), bool(_MORE.match(after) or _EARLIER.search(before)))  # part of a heading
        gazetteer = _vote(any(w in _FIRST for w in words), any(w in _NO_NAMES for w in words))
        check = _vote(False, not all(len(w) < 15 for w in words) or before.rstrip()[-1:] in ("", ".", "!", "?"))  # sentences begin so
    elif kind == "iban":
        shape = _vote(len(plain) == _IBAN_SIZES.get(span[:2]), len(plain) > 34)
        gazetteer = _vote(span[:2] in _IBAN_SIZES, True)
        check = _vote(_iban(plain), True)
    else:
        area = int(span[:3])
        touched = before[-1:] in tuple("./#_+=") and before != "" or after[:1] in tuple("/#_+=") and after != ""
        shape = _vote(not touched, touched)
        gazetteer = _vote(0 < area <= 772, area >= 900)
        check = _vote(True) if area not in (0, 666) and area < 900 and span[4:6] != "00" and span[7:] != "0000" and span not in _SPECIMENS else "-"
    near = before + " " + after
    context = _vote(bool(_SAYS_YES[kind].search(near)), bool(_SAYS_NO[kind].search(near)))
    return shape + gazetteer + context + check


def span_features(kind: str, span: str, before: str, after: str) -> str:
    """``FEATURES`` 0/1 characters of the span and its surroundings."""
    digits, letters = sum(c.isdigit() for c in span), sum(c.isalpha() for c in span)
    near = before + " " + after
    return "".join(
        "01"[bool(x)]
        for x in (
            len(span) >= 32,
            4 * digits >= len(span),
            letters and (span.lower() == span or span.upper() == span),
            before.rstrip("\"' ")[-1:] in ("=", ":") and before != "",
            before[-1:] in ('"', "'"),
            after[:1] in ('"', "'"),
            not before or before[-1:] == "\n",
            _TITLED.match(span) or _ISSUERS.match(span) or span[:2] in _IBAN_SIZES,
            len(_PARTS.findall(span)) > 1 or any(w in _NO_NAMES for w in span.split(" ")),
            _SAYS_YES[kind].search(near),
            _SAYS_NO[kind].search(near),
        )
    )


def _cut(kind: str, m: re.Match) -> int | None:
    """Where a candidate ends: an IBAN after as many characters as its country's have; None if it is too short, or a name one word twice."""
    if kind == "name" and len(set(words := m.group().split(" "))) < len(words):
        return None
    if kind != "iban":
        return m.end()
    places = [i for i, c in enumerate(m.group()) if c != " "]
    size = _IBAN_SIZES.get(m.group()[:2], len(places))
    return m.start() + places[min(size, len(places)) - 1] + 1 if len(places) >= 15 else None


def candidates(text: str, taken: list[tuple[str, int, int]], digits: bool, named: bool):
    """(kind, start, end, votes, features) of each candidate that no base span overlaps."""
    for kind in LEARNED:
        if not (named if kind == "name" else digits):
            continue
        for m in _CANDIDATES[kind].finditer(text):
            a, b = m.start(), _cut(kind, m)
            if b is None or any(a < e and s < b for _, s, e in taken):
                continue
            span, before, after = text[a:b], text[max(0, a - AROUND) : a], text[b : b + AROUND]
            yield kind, a, b, votes(kind, span, before, after), span_features(kind, span, before, after)


def _looks(texts: pa.Array):
    """For each text: whether it can hold any span, digits, a name."""
    texts = pc.fill_null(texts, "")
    digits = pc.match_substring_regex(texts, "[0-9]").to_numpy(zero_copy_only=False)
    emails = pc.match_substring(texts, "@").to_numpy(zero_copy_only=False)
    named = pc.match_substring_regex(texts, _NAMED).to_numpy(zero_copy_only=False)
    return digits | emails | named, digits, named


@dataclass
class Model:
    """Labelers' reliabilities by kind, and the span classifier's weights."""

    reliability: dict[str, dict]
    weights: np.ndarray

    def probability(self, kind: str, features: str) -> float:
        if kind not in self.reliability:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(_axes([(kind, features)]) @ self.weights, -30, 30)))[0])


def _axes(rows: list[tuple[str, str]]) -> np.ndarray:
    """Each kind has an intercept and weights of its own."""
    out = np.zeros((len(rows), len(LEARNED) * (FEATURES + 1)))
    for i, (kind, features) in enumerate(rows):
        at = LEARNED.index(kind) * (FEATURES + 1)
        out[i, at] = 1
        out[i, at + 1 : at + 1 + FEATURES] = [c == "1" for c in features]
    return out


def estimate(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], dict]:
    """(probability of each vote pattern, reliabilities) of one kind by expectation-maximisation.

    Two classes, votes independent given the class; a labeler that doesn't vote
    says nothing, and the majority of votes is each pattern's prior.  It starts from the majority of votes, and pseudo-votes keep
    every labeler better than chance where the data say little.
    Reliabilities are the shares of votes for, none and against by labeler.
    """
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], float)
    sign = np.array([[{"+": 1, "-": -1, "0": 0}[c] for c in p] for p in names])
    prior = sign.sum(axis=1) - 0.25
    true = 1 / (1 + np.exp(-2.0 * prior))
    shown = np.stack([sign == s for s in (1, 0, -1)], axis=2).astype(float)  # pattern, labeler, vote
    prior_true, prior_false = np.array([3.0, 2.0, 1.0]), np.array([1.0, 2.0, 3.0])
    for _ in range(rounds):
        w = n * true
        yes = np.einsum("p,plv->lv", w, shown) + prior_true
        no = np.einsum("p,plv->lv", n - w, shown) + prior_false
        yes, no = yes / yes.sum(axis=1, keepdims=True), no / no.sum(axis=1, keepdims=True)
        odds = prior + np.einsum("plv,lv->p", shown[:, :, ::2], (np.log(yes) - np.log(no))[:, ::2])
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - true).max() < 1e-9:
            break
        true = new
    return dict(zip(names, true.tolist(), strict=True)), {"share": float((n * true).sum() / n.sum()), "if_true": yes, "if_false": no}


def train(docs: DataFrame, *, text: str = "text") -> Model:
    """Votes on every candidate of ``docs``, reliabilities by EM, and the span classifier.

    Null and blank texts have no candidates; repeated rows count each time.  A
    kind without a candidate, as in an empty table, has no model and adds no
    span.
    """
    ship(docs.sparkSession)
    own = docs.select(docs[text].cast("string").alias("text")).where("text IS NOT NULL")

    def count(batches):
        for batch in batches:
            found: Counter = Counter()
            some, digits, named = _looks(batch.column(0))
            for i in np.flatnonzero(some):
                t = batch.column(0)[int(i)].as_py()
                found.update((k, v, f) for k, _, _, v, f in candidates(t, base_spans(t), digits[i], named[i]))
            if found:
                rows = list(found.items())
                yield pa.RecordBatch.from_arrays([pa.array([r[0][j] for r in rows], pa.string()) for j in range(3)] + [pa.array([r[1] for r in rows], pa.int64())], names=["kind", "votes", "features", "n"])

    # At most kinds * 3 ** LABELERS * 2 ** FEATURES rows.
    counts = own.mapInArrow(count, "kind string, votes string, features string, n long").groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")).collect()
    counts = sorted(counts)
    reliability, soft = {}, {}
    for kind in LEARNED:
        patterns: dict[str, int] = {}
        for r in counts:
            if r["kind"] == kind:
                patterns[r["votes"]] = patterns.get(r["votes"], 0) + r["n"]
        if patterns:
            soft[kind], reliability[kind] = estimate(patterns)
    weights = np.zeros(len(LEARNED) * (FEATURES + 1))
    if counts:
        x = _axes([(r["kind"], r["features"]) for r in counts])
        y = np.array([soft[r["kind"]][r["votes"]] for r in counts])
        n = np.array([r["n"] for r in counts], float)
        for _ in range(60):  # Newton's method with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(weights)), x.T @ (n * (y - p)) - 0.1 * weights)
            weights = weights + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
    return Model(reliability, weights)


def find(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None, redacted: bool = False) -> DataFrame:
    """Adds spans: (kind, start, end) by kind, then start; code points, end exclusive.

    With ``redacted`` also clean_text, the text with each span replaced by its
    kind in brackets.  Null and blank texts have no spans.  Input columns of
    these names give way.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(texts, _):
        some, digits, named = _looks(texts)
        spans: list[list] = [[] for _ in range(len(texts))]
        known: dict = {}
        for i in np.flatnonzero(some):
            t = texts[int(i)].as_py()
            own = base_spans(t)
            for k, a, b, _, f in candidates(t, list(own), digits[i], named[i]):
                if (k, f) not in known:
                    known[k, f] = model.probability(k, f) >= 0.5
                if known[k, f]:
                    own.append((k, a, b))
            spans[i] = own
        out = [pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in own] for own in spans], kind)]
        if redacted:
            clean = []
            for t, own in zip(texts.to_pylist(), spans, strict=True):
                if own:
                    pieces, last = [], 0
                    for k, a, b in sorted(own, key=lambda s: (s[1], -s[2])):
                        if b <= last:
                            continue
                        pieces += [t[last : max(a, last)], f"[{k.upper()}]"]
                        last = b
                    t = "".join([*pieces, t[last:]])
                clean.append(t)
            out.append(pa.array(clean, pa.string()))
        return out

    item = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [T.StructField("spans", T.ArrayType(item))]
    if redacted:
        fields.append(T.StructField("clean_text", T.StringType()))
    return map_text(docs, run, fields, text, keep)


def redact(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; the columns stay."""
    renamed = docs.select(*[docs[c].alias("in_" + c) for c in docs.columns])
    found = find(renamed, model, text="in_" + text, redacted=True)
    return found.select(*[F.col("clean_text" if c == text else "in_" + c).alias(c) for c in docs.columns])


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = find(docs, train(docs), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
