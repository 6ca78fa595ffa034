"""BPE encoding and decoding by tree concatenation.

A text is cut at ASCII white space, where no piece of the tokenizer can span
the cut, so both sides agree as they are.  Each distinct run of a chunk is
encoded once, and a task remembers pieces.  A long unsplit run is normalised and split as the vocabulary file
says; a piece of over ``LEAF`` symbols is cut into a tree of halves, its leaves
are encoded in one batch (which the library spreads over its threads), and the
halves are joined level by level: a window of tokens around the join is encoded
again and grows until its first token is the left side's and its last token is
the right side's.  A sequence all of whose neighbouring tokens belong together
is the encoding of its text, so the joined sequence is exact.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import give_back, read, ship
from .textkernel import SPACED, Words, chunks, map_text, string_buffers

#: Longest run, in characters, that the library encodes in one go.
LONG_RUN = 64
#: Symbols in a leaf of the tree.
LEAF = 32
#: Distinct pieces that a task remembers.
CACHE = 100_000


class Codec:
    """A tokenizers file with a BPE model and no decoder: encodes runs, decodes ids."""

    def __init__(self, path: str, leaf: int = LEAF, long_run: int = LONG_RUN):
        from tokenizers import Tokenizer

        self.path, self.leaf, self.long_run = path, leaf, long_run
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        if self.whole.decoder is not None or type(self.whole.model).__name__ != "BPE":
            raise ValueError("this codec wants a BPE model without a decoder")
        if not self._drops_space():
            raise ValueError("this codec wants a tokenizer that drops ASCII white space and knows no word by what is around it")
        self.model = self.whole.model
        self.special = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.plain = self._plain_split()
        self.cache: dict[str, bytes] = {}
        self._inner = self._width = None

    @property
    def inner(self):
        """The same model without word ends, for all leaves but the last."""
        if self._inner is None:
            from tokenizers import Tokenizer, models

            with open(self.path, encoding="utf-8") as f:
                spec = json.load(f)["model"]
            merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["merges"]]
            self._inner = Tokenizer(models.BPE(vocab=spec["vocab"], merges=merges))
        return self._inner

    @property
    def width(self) -> dict[int, int]:
        """Symbols of each token."""
        if self._width is None:
            suffix = self.model.end_of_word_suffix or ""
            self._width = {i: len(n.removesuffix(suffix)) if suffix else len(n) for n, i in self.whole.get_vocab(with_added_tokens=True).items()}
        return self._width

    def _drops_space(self) -> bool:
        """Whether texts may be cut at white space: every run's ids are its own, and white space has none."""
        ids = lambda text: self.whole.encode(text, add_special_tokens=False).ids
        words = ["a", "hello", "World", "1", "é", ".", "don't"]
        alone = [i for w in words for i in ids(w)]
        return all(ids(edge + gap.join(words) + edge) == alone for c in " \t\n\x0b\x0c\r" for gap in (c, 2 * c) for edge in ("", c))

    def _plain_split(self):
        """The file's own split pattern, if its steps are those that ``run`` takes by itself."""
        import regex

        if self.whole.pre_tokenizer is None or self.whole.normalizer is None:
            return None
        steps = json.loads(self.whole.pre_tokenizer.__getstate__()).get("pretokenizers") or [{}]
        norms = [n.get("type") for n in json.loads(self.whole.normalizer.__getstate__()).get("normalizers") or []]
        known = [s.get("type") for s in steps] == ["Split", "ByteLevel"] and norms == ["NFC", "Replace", "Lowercase"]
        known = known and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
        return regex.compile(steps[0]["pattern"]["Regex"]) if known else None

    def piece(self, symbols: str) -> list[int]:
        """The ids of one piece of the pre-tokenizer, by tree concatenation if it is long."""
        n = len(symbols)
        if n <= self.leaf:
            return self._direct(symbols, True)
        bounds = [(0, n)]
        while bounds[0][1] - bounds[0][0] > self.leaf:
            bounds = [x for a, b in bounds for x in ((a, (a + b) // 2), ((a + b) // 2, b))]
        parts = [e.ids for e in self.inner.encode_batch([symbols[a:b] for a, b in bounds[:-1]], add_special_tokens=False)]
        parts.append(self._direct(symbols[bounds[-1][0] :], True))
        ends = [b for _, b in bounds]
        while len(parts) > 1:
            parts = [self._join(parts[i], parts[i + 1], symbols, ends[i], ends[i + 1] == n) for i in range(0, len(parts), 2)]
            ends = ends[1::2]
        return parts[0]

    def _direct(self, symbols: str, final: bool) -> list[int]:
        if final:
            return [t.id for t in self.model.tokenize(symbols)]
        return self.inner.encode(symbols, add_special_tokens=False).ids

    def _join(self, left: list[int], right: list[int], symbols: str, at: int, final: bool) -> list[int]:
        i, j = min(2, len(left)), min(2, len(right))
        while True:
            a = at - sum(self.width[t] for t in left[len(left) - i :])
            b = at + sum(self.width[t] for t in right[:j])
            middle = self._direct(symbols[a:b], final and j == len(right))
            left_agrees = i == len(left) or middle[0] == left[-i]
            right_agrees = j == len(right) or middle[-1] == right[j - 1]
            if left_agrees and right_agrees:
                return [*left[: len(left) - i], *middle, *right[j:]]
            if not left_agrees:
                i = min(2 * i, len(left))
            if not right_agrees:
                j = min(2 * j, len(right))

    def long_text(self, text: str) -> list[int]:
        """The ids of any text, each piece by ``piece``; what the library's encode gives."""
        out: list[int] = []
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                norm = self.whole.normalizer.normalize_str(part) if self.whole.normalizer else part
                for symbols, _ in self.whole.pre_tokenizer.pre_tokenize_str(norm):
                    out.extend(self.piece(symbols))
        return out

    def _piece_bytes(self, symbols: str) -> bytes:
        got = self.cache.get(symbols)
        if got is None:
            if len(self.cache) > CACHE:
                self.cache.clear()
            got = self.cache[symbols] = array("I", self.piece(symbols)).tobytes()
        return got

    def run(self, text: str) -> bytes:
        """One run's ids as little-endian unsigned 32-bit integers.

        Plain Latin runs, which every Unicode version normalises and splits
        alike, are split here; all others go through the library's own steps.
        """
        if self.plain is None or len(text) > self.long_run or not _PLAIN.fullmatch(text) or "<|" in text:
            return np.array(self.long_text(text), "<u4").tobytes()
        pieces = self.plain.findall(text.lower())
        if not text.isascii():
            pieces = [p if p.isascii() else p.encode().decode("latin-1").translate(_BYTE_LEVEL) for p in pieces]
        if len(pieces) == 1:
            return self._piece_bytes(pieces[0])
        return b"".join([self._piece_bytes(p) for p in pieces])

    def runs(self, texts: list[str]) -> list[bytes]:
        return [self.run(t) for t in texts]


#: Runs of printable ASCII and of Latin letters and signs below U+0250.
_PLAIN = re.compile("[!-~\u00a1-\u024f]+")
#: Byte-level symbols: printable Latin-1 bytes stand for themselves, the rest count up from U+0100.
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))}


def token_table(path: str) -> pa.Array:
    """The tokens of a tokenizers file by id, each with a space behind it."""
    from tokenizers import Tokenizer

    if path not in _TABLES:
        names = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
        table = [" "] * (max(names.values()) + 1)
        for name, i in names.items():
            table[i] = name + " "
        _TABLES[path] = pa.array(table, pa.string())
    return _TABLES[path]


_TABLES: dict[str, pa.Array] = {}
_CODECS: dict[tuple, Codec] = {}


def codec(path: str, **options) -> Codec:
    key = (path, *sorted(options.items()))
    if key not in _CODECS:
        _CODECS[key] = Codec(path, **options)
    return _CODECS[key]


def _texts(tokens: pa.Array, offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """The text of each binary value's packed ids: their tokens joined by one space."""
    own = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), "<u4")
    o, d = string_buffers(pc.take(tokens, pa.array(own)))
    at = o[(offsets - offsets[0]) // 4]
    body = d.tobytes()
    return pa.array([body[a : max(a, b - 1)].decode() for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())


def encode(docs: DataFrame, vocabulary: str, *, text: str = "text", keep: list[str] | None = None, ids: str = "token_ids", decoded: str | None = None, leaf: int = LEAF, long_run: int = LONG_RUN) -> DataFrame:
    """Adds ``ids``: each text's token ids, packed as little-endian unsigned 32-bit integers.

    Without special tokens added, truncation or padding; the strings of special
    tokens in a text count as these, as in the library.  Null and blank texts
    give no ids.  ``vocabulary`` is a path that every executor has.  An input
    column named ``ids`` gives way.  ``decoded`` names a column for what
    ``decode`` makes of the packed ids, so both take one pass of one worker.
    """

    def run(texts, _):
        words = Words(texts, SPACED)
        packed = pa.array(codec(vocabulary, leaf=leaf, long_run=long_run).runs(words.uniq.to_pylist()), pa.binary())
        offsets, data = string_buffers(pc.take(packed, pa.array(words.codes)))
        offsets = offsets[words.offs]
        out = [pa.Array.from_buffers(pa.binary(), words.n_docs, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data)])]
        return out if decoded is None else [*out, _texts(token_table(vocabulary), offsets, data)]

    fields = [T.StructField(ids, T.BinaryType()), *([] if decoded is None else [T.StructField(decoded, T.StringType())])]
    return map_text(docs, run, fields, text, keep)


def decode(encoded: DataFrame, vocabulary: str, *, ids: str = "token_ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Adds ``out``: the text that the library's decode gives for packed ids, special tokens included.

    Null or empty ids give the empty text.
    """
    ship(encoded.sparkSession)
    kept = [c for c in (encoded.columns if keep is None else keep) if c != out]

    def run(batches):
        tokens = token_table(vocabulary)
        for batch in batches:
            for part in chunks(batch, "ids"):
                texts = _texts(tokens, *string_buffers(part.column(len(kept))))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(kept))], texts], names=[*kept, out])
                del texts
        give_back()

    schema = T.StructType([*[T.StructField(c, encoded.schema[c].dataType) for c in kept], T.StructField(out, T.StringType())])
    source = encoded.select(*[encoded[c].alias(f"k{i}") for i, c in enumerate(kept)], encoded[ids].alias("ids"))
    return source.mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_vocabulary()
    done = encode(read(spark, sf_dir, "documents"), path, keep=["doc_id"], decoded="decoded")
    return done.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
