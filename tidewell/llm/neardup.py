"""MinHash near-duplicates from bottom-k sketches of one hash function.

1. A document's set is its distinct shingles, hashed to 64 bits; equal sets
   (by 128-bit digest) collapse into one class before anything is compared.
2. A class keeps its ``SKETCH`` smallest hashes.  Two sets with Jaccard 0.8 or
   more share at least ``SHARED`` of them but for a chance of 3e-9 at exactly
   0.8, so by the prefix principle they meet in the inverted list of a value
   among all but the SHARED - 1 most frequent ones of each.  Values that one
   class alone retains count as that class's rarest and make no list.
3. In each list the union-sketch estimate admits pairs, and the list returns a
   spanning forest of the admitted pairs, never the pairs themselves.
   Components of all forests are clusters that contain every true link.
4. Full sets travel to their clusters once.  A cluster counts intersections by
   an inverted index and verifies Jaccard exactly for any two classes that no
   chain of verified links joins yet; its answer is a forest of true links.
   A list of over ``LIST_MEMBERS`` or a cluster of over ``CLUSTER_SHINGLES`` is
   dealt as pairs of blocks, so no task holds more than two blocks of it.
5. Components of the verified forests are the groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .runtime import checkpointed, read, ship
from .textkernel import SPACED_LOWER, Words, inside, map_text, rolling_hash, string_buffers

SHINGLE = 5
THRESHOLD = 80
#: Retained values of a set, and how many of them a link shares at least.
SKETCH, SHARED = 32, 11
#: Shingles of a cluster's block, members of a list's block.
CLUSTER_SHINGLES, LIST_MEMBERS = 4_000_000, 50_000


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a shorter text's words make one shingle."""
    words = Words(texts, SPACED_LOWER)
    hashes = words.hashes()
    rolled = rolling_hash(hashes, size)
    out = []
    for a, b in zip(words.offs[:-1], words.offs[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        else:
            out.append(rolling_hash(hashes[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def _digest(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _csr(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    offs = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=offs[1:])
    return offs, np.concatenate(lists) if lists else np.zeros(0, np.uint64)


def forest(lists: list[np.ndarray], accept: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs (x, y) of ``lists`` that ``accept`` admits.

    ``accept(x, others, overlaps)`` judges x against others that share values
    with it.  Whoever a chain of admitted pairs already joins isn't compared
    again; the member in most postings goes first, so one pass over a family
    of near copies joins the bulk of it.
    """
    m = len(lists)
    offs, values = _csr(lists)
    owner = np.repeat(np.arange(m, dtype=np.int32), np.diff(offs))
    _, code, freq = np.unique(values, return_inverse=True, return_counts=True)
    postings = owner[np.argsort(code, kind="stable")]
    at = np.concatenate([[0], np.cumsum(freq)])
    weight = np.bincount(owner, weights=freq[code].astype(float), minlength=m)
    label = np.arange(m)
    count = np.ones(m, np.int64)
    largest = 0
    edges: list[tuple[int, int]] = []
    order = np.argsort(-weight, kind="stable").tolist()
    passed: list[int] = []
    for turn, x in enumerate(chain(order, passed)):
        if len(edges) == m - 1:
            break
        # A pair across the largest component's border is judged from its other end.  Another component may
        # take over, so who was passed over has a second turn, when that one stays exempt as it grows.
        again = turn >= m
        if count[largest] > 1 and label[x] == largest:
            if not again:
                passed.append(x)
            continue
        own = code[offs[x] : offs[x + 1]]
        own = own[freq[own] > 1]
        if not len(own):
            continue
        met = np.concatenate([postings[at[c] : at[c + 1]] for c in own])
        met = met[label[met] != label[x]]
        if not len(met):
            continue
        others, overlaps = np.unique(met, return_counts=True)
        admitted = others[accept(int(x), others, overlaps)]
        joined, first = np.unique(label[admitted], return_index=True)
        if len(joined):
            edges += [(int(x), int(y)) for y in admitted[first]]
            here = label[x]
            count[here] += count[joined].sum()
            label[np.isin(label, joined)] = here
            if largest in joined or not again and count[here] > count[largest]:
                largest = here
    return edges


def groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of equal ``key`` in sorted batches, each as one table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        offs, data = string_buffers(batch.column(key).cast(pa.binary()) if pa.types.is_string(batch.column(key).type) else batch.column(key)) if pa.types.is_binary(batch.column(key).type) or pa.types.is_string(batch.column(key).type) else (None, None)
        if offs is None:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
            first = values[0]
        else:
            names = batch.column(key).to_pylist()
            cuts = np.array([i for i in range(1, len(names)) if names[i] != names[i - 1]], np.int64)
            first = names[0]
        bounds = [0, *cuts.tolist(), batch.num_rows]
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(bounds[:-2], bounds[1:-1], strict=True):
            held.append(batch.slice(a, b - a))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(bounds[-2]))
        last = batch.column(key)[batch.num_rows - 1].as_py()
    if held:
        yield pa.Table.from_batches(held)


def _unpack(column: pa.ChunkedArray, dtype: str) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks:
        offs, data = string_buffers(chunk)
        body = data[offs[0] : offs[-1]].tobytes() if len(chunk) else b""
        out += [np.frombuffer(body, dtype, (b - a) // np.dtype(dtype).itemsize, a) for a, b in zip(offs[:-1] - offs[0], offs[1:] - offs[0], strict=True)]
    return out


_EDGE = T.StructType([T.StructField("u", T.BinaryType()), T.StructField("v", T.BinaryType())])


def _edges(keys: list[bytes], pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([keys[a] for a, _ in pairs], pa.binary()), pa.array([keys[b] for _, b in pairs], pa.binary())], names=["u", "v"])


def least_shared(n: np.ndarray) -> np.ndarray:
    """Retained values that a set of n shingles shares with any set it links to."""
    return np.minimum(SHARED, -(-n * THRESHOLD // 100))


#: Fills the places of sketches shorter than SKETCH.
_NONE = np.uint64(1 << 32)


def _matrix(sketches: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(sketches), SKETCH), _NONE)
    for row, s in zip(out, sketches, strict=True):
        row[: len(s)] = s
    return out


def near_by_sketch(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """For rows of sketches of sets of n and m shingles: whether the union's own sketch admits the pair.

    The union's sketch is the SKETCH smallest values of both; what of it is in
    both estimates the Jaccard similarity.
    """
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both != _NONE
    twin = np.zeros(both.shape, bool)
    twin[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    rank = np.cumsum(real & ~twin, axis=1)
    common = (twin & (rank <= SKETCH)).sum(axis=1)
    union = np.minimum(rank[:, -1], SKETCH)
    # Halved hashes may rarely coincide, so small sets, which are whole here, get one value's grace.
    admitted = np.where(union >= SKETCH, common >= SHARED, 100 * (common + 1) >= THRESHOLD * union)
    return admitted & (100 * np.minimum(n, m) >= THRESHOLD * np.maximum(n, m))


def _admit(matrix: np.ndarray, sizes: np.ndarray) -> Callable:
    need = least_shared(sizes)

    def accept(x: int, others: np.ndarray, overlaps: np.ndarray) -> np.ndarray:
        near = overlaps >= np.maximum(need[x], need[others])
        some = others[near]
        near[near] = near_by_sketch(np.broadcast_to(matrix[x], (len(some), SKETCH)), matrix[some], sizes[x], sizes[some])
        return near

    return accept


def _list_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of the lists in sorted batches; a batch's lists of two are judged together."""
    held: list[pa.RecordBatch] = []

    def work(part: pa.Table) -> pa.RecordBatch | None:
        values, sizes = part.column("value").to_numpy(), part.column("n").to_numpy()
        sketches, keys = _unpack(part.column("sketch"), "<u4"), part.column("key").to_pylist()
        matrix = _matrix(sketches)
        cuts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
        starts, members = cuts[:-1], np.diff(cuts)
        twos = starts[members == 2]
        near = twos[near_by_sketch(matrix[twos], matrix[twos + 1], sizes[twos], sizes[twos + 1])]
        pairs = [(int(x), int(x) + 1) for x in near]
        for a, m in zip(starts[members > 2], members[members > 2], strict=True):
            found = forest(sketches[a : a + m], _admit(matrix[a : a + m], sizes[a : a + m]))
            pairs += [(int(a) + x, int(a) + y) for x, y in found]
        return _edges(keys, pairs) if pairs else None

    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(values, values[-1], side="left"))  # the last list may go on
        if held and held[-1].column(0)[held[-1].num_rows - 1].as_py() != values[0]:
            if (out := work(pa.Table.from_batches(held))) is not None:
                yield out
            held = []
        if cut:
            if (out := work(pa.Table.from_batches([*held, batch.slice(0, cut)]))) is not None:
                yield out
            held = []
        held.append(batch.slice(cut))
    if held and (out := work(pa.Table.from_batches(held))) is not None:
        yield out


def _cluster_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in groups_of(batches, "part"):
        keys = table.column("key").to_pylist()
        sets = _unpack(table.column("shingles"), "<u8")
        once = list({k: i for i, k in enumerate(keys)}.values())
        keys, sets = [keys[i] for i in once], [sets[i] for i in once]
        sizes = np.array([len(s) for s in sets], np.int64)

        def linked(x: int, others: np.ndarray, overlaps: np.ndarray) -> np.ndarray:
            return 100 * overlaps >= THRESHOLD * (sizes[x] + sizes[others] - overlaps)

        if found := forest(sets, linked):
            yield _edges(keys, found)


def sketches(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n, key, sketch, high): set size, set digest, bottom-k hashes and their upper halves."""

    def run(texts, _):
        sets = shingle_sets(texts, shingle)
        low = [s[:SKETCH] for s in sets]
        return [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([_digest(s) for s in sets], pa.binary()),
            pa.array([x.view(np.int64) for x in low], pa.list_(pa.int64())),
            pa.array([(x >> np.uint64(32)).astype("<u4").tobytes() for x in low], pa.binary()),
        ]

    fields = [T.StructField("n", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType())), T.StructField("high", T.BinaryType())]
    return map_text(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), run, fields, "text", ["doc_id"])


def near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents with Jaccard 0.8 or more on word shingles are linked; a
    component is named by its smallest doc_id.  Null and blank texts have
    empty sets and are linked with nothing.  Rows that repeat a doc_id share
    its fate where their texts agree, and are judged by their own text where
    not.  Rows without a doc_id are linked with nothing: their component_id is
    null and they are kept.  Other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    found = checkpointed(sketches(docs, text=text, doc_id=doc_id, shingle=shingle))
    named = found.where("doc_id IS NOT NULL AND key IS NOT NULL")
    classes = checkpointed(named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("high").alias("high")))

    # Inverted lists of the values that several classes retain, each class in its rarest ones.
    entries = classes.select("key", F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = entries.join(shared, "value").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))
    need = F.least(F.lit(SHARED), F.ceil(F.col("n") * THRESHOLD / 100)).cast("int")
    chosen = (
        own.join(classes.select("key", "n", "high"), "key")
        .withColumn("take", F.size("values") - need + 1)
        .where("take > 0")
        .select("key", "n", F.col("high").alias("sketch"), F.explode(F.slice("values", F.lit(1), F.col("take"))).alias("e"))
        .select("key", "n", "sketch", "e.df", F.col("e.value").alias("own"))
    )
    # A list that may exceed a block is dealt as pairs of blocks; a name's collision only adds candidates.
    blocks = F.ceil(F.col("df") / LIST_MEMBERS).cast("int")
    chosen = chosen.withColumns({"blocks": blocks, "b": F.pmod(F.xxhash64("key"), blocks).cast("int")})
    names = F.expr("if(blocks = 1, array(own), transform(sequence(0, blocks - 1), j -> xxhash64(own, least(b, j), greatest(b, j))))")
    chosen = chosen.select(F.explode(names).alias("value"), "key", "n", "sketch")
    lists = chosen.repartition(_width(spark), "value").sortWithinPartitions("value")
    clusters = components(lists.mapInArrow(_list_forests, _EDGE))

    # Full sets go to their clusters, large clusters as pairs of blocks.
    members = checkpointed(classes.select("key", "rep", "n").join(clusters.withColumnRenamed("node", "key"), "key"))
    # Only the few that exceed a block are joined, so a component of any size is no key of a large join.
    totals = members.groupBy("component").agg(F.ceil(F.sum("n") / CLUSTER_SHINGLES).cast("int").alias("blocks")).where("blocks > 1")
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    placed = (
        members.join(totals, "component", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("b", block)
        .withColumn("parts", F.expr("transform(sequence(0, blocks - 1), j -> concat(hex(component), ':', least(b, j), ':', greatest(b, j)))"))
        .select("key", "rep", "parts")
    )
    texts = docs.select(docs[doc_id].alias("rep"), docs[text].cast("string").alias("text")).where("rep IS NOT NULL AND text IS NOT NULL")

    def full(column, _):
        sets = shingle_sets(column, shingle)
        return [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())]

    sets = map_text(placed.join(texts, "rep"), full, [T.StructField("got", T.BinaryType()), T.StructField("shingles", T.BinaryType())], "text", ["key", "parts"])
    sets = sets.where("got = key").select("key", "shingles", F.explode("parts").alias("part"))
    links = sets.repartition(_width(spark), "part").sortWithinPartitions("part").mapInArrow(_cluster_links, _EDGE)
    groups = components(links)

    names = classes.select("key", "rep").join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = names.groupBy("component").agg(F.min("rep").alias("component_id"))
    names = names.join(least, "component").select("key", "component_id")
    out = found.join(names, "key", "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=4)


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
