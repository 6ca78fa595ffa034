import hashlib
from collections import defaultdict

import pytest

from tidewell.llm import registry, sharding
from tests.llm.helpers import awkward, frame, passage
from tests.oracle import assert_same


def brute(rows, limit):
    bits = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:8], 16)
    size = lambda t: len((t or "").encode())
    out = []
    for i, _ in rows:
        for depth in range(33):
            p = bits(i) >> (32 - depth)
            own = [(j, t) for j, t in rows if bits(j) >> (32 - depth) == p]
            total = sum(size(t) for _, t in own)
            if total <= limit or depth == 32:
                out.append((i, depth, p, total, len(own), total > limit))
                break
    return out


def check(spark, rows, limit):
    got = sharding.assign_shards(frame(spark, rows), limit=limit, keep=["doc_id"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows, limit)))


@pytest.mark.parametrize("limit", [10**9, 20_000, 900, 300, 10])
def test_brute_force(spark, limit):
    check(spark, awkward() + [(100 + i, passage(i, 5 + i % 30)) for i in range(80)], limit)


def test_every_shard_fits_or_is_marked(spark):
    found = sharding.assign_shards(frame(spark, [(i, passage(i, 40)) for i in range(300)]), limit=3000).collect()
    by = defaultdict(list)
    for r in found:
        by[r.shard_depth, r.shard_prefix].append(r)
    assert all(sum(len(r.text) for r in rows) == rows[0].shard_bytes <= 3000 for rows in by.values())
    assert len({r.shard_depth for r in found}) > 1  # only oversized buckets split


def test_written_shards(spark, tmp_path):
    docs = frame(spark, [(i, passage(i, 40)) for i in range(50)])
    sharding.write_shards(docs, f"file://{tmp_path}/out", limit=4000)
    assert spark.read.parquet(f"file://{tmp_path}/out").drop("shard").count() == 50
    assert all(p.name.startswith("shard=") or p.name.startswith(("_", ".")) for p in (tmp_path / "out").iterdir())


def test_empty_table(spark):
    assert sharding.assign_shards(frame(spark, [])).count() == 0


def test_sql(spark, tiny, monkeypatch):
    assert_same(registry.queries()["op9_sharding"], registry.oracle_sql()["op9_sharding"], spark, tiny)
