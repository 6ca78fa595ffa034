"""Vectorised word handling over Arrow string columns.

A batch is cut into chunks of bounded bytes; within a chunk the words are
dictionary-encoded by Arrow, so hashing and lookups touch each distinct word
once and everything per word is numpy on integer codes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .runtime import give_back, mix64, ship

#: Text bytes handled at once; a longer document makes a chunk of its own.
CHUNK_BYTES = 2 << 20


def _table(keep, lower: bool) -> bytes:
    out = bytearray(256)
    for b in range(256):
        out[b] = (b + 32 if lower and 65 <= b <= 90 else b) if keep(b) else 32
    return bytes(out)


def _is_space(b: int) -> bool:
    return b == 32 or 9 <= b <= 13


#: Words are runs of anything but ASCII white space.
SPACED = None
#: The same, with A-Z lower-cased first.
SPACED_LOWER = _table(lambda b: not _is_space(b), True)
#: Words are runs of 0-9, a-z (A-Z lower-cased) and everything beyond ASCII.
ALNUM_LOWER = _table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128, True)


def _seeded(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = _seeded(256, 0x51ED27)
_POS = [_seeded(1024, 0xC0FFEE) | np.uint64(1)]


def _positions(n: int) -> np.ndarray:
    if len(_POS[0]) < n:
        _POS[0] = _seeded(max(n, 2 * len(_POS[0])), 0xC0FFEE) | np.uint64(1)
    return _POS[0]


def hash_strings(arr: pa.StringArray) -> np.ndarray:
    """64-bit hashes of the strings' bytes; the same on every machine and run."""
    offsets, data = string_buffers(arr)
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint64)
    lengths = np.diff(offsets)
    total = int(offsets[-1] - offsets[0])
    if total == 0:
        return mix64(lengths.astype(np.uint64))
    body = data[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    pos = np.arange(total, dtype=np.int64) - np.repeat(starts, lengths)
    values = _BYTE[body] * _positions(int(lengths.max()))[pos]
    sums = np.add.reduceat(np.append(values, np.uint64(0)), starts)
    sums[lengths == 0] = 0
    return mix64(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def string_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets as int64, bytes) of a string or binary array; its nulls have length 0."""
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if pa.types.is_binary(arr.type) else "")
    if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = arr.buffers()
    if len(arr) == 0 or offsets is None:
        return np.zeros(len(arr) + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, dtype=width)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    return off, (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8))


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch whose texts take ``limit`` bytes at most, or one document."""
    if batch.num_rows == 0:
        return
    offsets, _ = string_buffers(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def recoded(arr: pa.StringArray, table: bytes | None) -> pa.StringArray:
    """The strings with each byte mapped by ``table``; lengths don't change."""
    if table is None:
        return arr
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    offsets, data = string_buffers(arr)
    body = data[offsets[0] : offsets[-1]].tobytes().translate(table)
    return pa.StringArray.from_buffers(len(arr), pa.py_buffer((offsets - offsets[0]).astype(np.int32).tobytes()), pa.py_buffer(body))


class Words:
    """The words of some texts: document i has words ``offs[i]:offs[i + 1]``.

    ``codes`` gives each word's place in ``uniq``, the distinct words.  Null
    texts have no words.
    """

    def __init__(self, texts: pa.Array, table: bytes | None = SPACED):
        if pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.string())
        lists = pc.ascii_split_whitespace(recoded(pc.fill_null(texts, ""), table))
        flat = lists.flatten()
        offs = np.zeros(len(lists) + 1, np.int64)
        if len(lists):
            np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=offs[1:])
        enc = flat.dictionary_encode()
        self.uniq = enc.dictionary
        codes = enc.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        lengths = pc.binary_length(self.uniq).to_numpy(zero_copy_only=False)
        blank = np.flatnonzero(lengths == 0)
        if len(blank):
            keep = codes != blank[0]
            kept = np.zeros(len(codes) + 1, np.int64)
            np.cumsum(keep, out=kept[1:])
            codes, offs = codes[keep], kept[offs]
        self.codes, self.offs = codes, offs
        self.n_docs = len(lists)
        self._hash = None

    def __len__(self) -> int:
        return len(self.codes)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offs)

    def uniq_hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = hash_strings(self.uniq)
        return self._hash

    def hashes(self) -> np.ndarray:
        return self.uniq_hash()[self.codes]

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts)

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(offsets by document, bytes): the kept words of each document joined by one space."""
        codes, offs = self.codes, self.offs
        if keep is not None:
            kept = np.zeros(len(codes) + 1, np.int64)
            np.cumsum(keep, out=kept[1:])
            codes, offs = codes[keep], kept[offs]
        body, ends = gather_joined(self.uniq, codes)
        at = np.concatenate([[0], ends])[offs]
        return at, body


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of arange(start, start + length)."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def gather_joined(uniq: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end offset of each word with the space behind it) of the coded words in order."""
    if len(codes) == 0:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    spaced = pc.binary_join_element_wise(uniq, "", " ") if len(uniq) else uniq
    offsets, data = string_buffers(spaced)
    taken = pc.take(spaced, pa.array(codes))
    offsets, data = string_buffers(taken)
    return data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def window_any(hit: np.ndarray, size: int, n: int) -> np.ndarray:
    """Marks the positions 0..n-1 that some window starting at a ``hit`` covers."""
    delta = np.zeros(n + 1, np.int32)
    starts = np.flatnonzero(hit)
    np.add.at(delta, starts, 1)
    np.add.at(delta, np.minimum(starts + size, n), -1)
    return np.cumsum(delta[:n]) > 0


def doc_sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The sum of each document's values, whatever stands before it in the chunk."""
    out = np.zeros(len(offs) - 1)
    some = np.flatnonzero(offs[1:] > offs[:-1])
    if len(some):
        out[some] = np.add.reduceat(values, offs[:-1][some])
    return out


def rolling_hash(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` values, order counted."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for i in range(size):
        acc *= np.uint64(0x9E3779B97F4A7C15)
        acc += values[i : i + n]
        acc ^= acc >> np.uint64(29)
    return mix64(acc)


def inside(doc: np.ndarray, size: int) -> np.ndarray:
    """For each window start, whether the window stays in one document; ``doc`` is by word."""
    n = len(doc) - size + 1
    return doc[:n] == doc[size - 1 :] if n > 0 else np.zeros(0, bool)


def map_text(
    docs: DataFrame,
    fn: Callable[[pa.Array, pa.RecordBatch], list],
    fields: list[T.StructField],
    text: str = "text",
    keep: list[str] | None = None,
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """``docs``' ``keep`` columns (all by default) and what ``fn`` finds for each text.

    ``fn(texts, chunk)`` gives one list or Arrow array for each of ``fields``,
    aligned with the chunk's rows.  An input column named like an output field
    gives way to it.  No shuffle; memory is bounded by a chunk.
    """
    ship(docs.sparkSession)
    new = {f.name for f in fields}
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    source = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(kept)], docs[text].cast("string").alias("t"))
    kept_fields = [T.StructField(c, docs.schema[c].dataType) for c in kept]
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "t", limit):
                out = fn(part.column(len(kept)), part)
                arrays = [part.column(i) for i in range(len(kept))]
                arrays += [a if isinstance(a, pa.Array) else pa.array(a, type=t) for a, t in zip(out, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *[f.name for f in fields]])
        give_back()

    return source.mapInArrow(run, T.StructType([*kept_fields, *fields]))
