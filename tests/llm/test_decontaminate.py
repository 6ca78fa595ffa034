import re

import pytest

from tidewell.llm import decontaminate, registry
from tests.llm.helpers import awkward, frame, passage
from tests.oracle import assert_same


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(rows, items, window=13):
    wins = {}
    for i, t in items:
        w = words(t)
        if w:
            for a in range(max(1, len(w) - window + 1)):
                wins.setdefault(tuple(w[a : a + window]), set()).update([] if i is None else [str(i)])
    sizes = {len(k) for k in wins}
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for size in sizes:
            for a in range(len(w) - size + 1):
                if (own := wins.get(tuple(w[a : a + size]))) is not None:
                    hit |= set(range(a, a + size))
                    found |= own
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


ITEMS = [(1, passage(50, 40)), (2, passage(50, 40)), (3, "Short, one!"), (4, None), (5, "..."), (None, passage(51, 30)), (10, passage(52, 13)), (11, passage(50, 20))]


def documents():
    p, q = passage(50, 40), passage(52, 13)
    rows = [(100, "before " + p.upper().replace(" ", " -- ") + " after"), (101, "x " * 900 + q), (102, "short one"), (103, "short two one"), (104, passage(51, 30)), (105, p + " " + q), (106, " ".join(p.split()[:12]))]
    return awkward() + rows


def check(spark, monkeypatch, blocks):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", blocks)
    got = decontaminate.scan_contamination(frame(spark, documents()), bench(spark, ITEMS), keep=["doc_id"])
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, brute(documents(), ITEMS)))


@pytest.mark.parametrize("blocks", [1_000_000, 7])
def test_brute_force_in_one_block_and_in_many(spark, monkeypatch, blocks):
    check(spark, monkeypatch, blocks)


def test_removal_of_documents_and_spans(spark):
    docs, items = frame(spark, documents()), bench(spark, ITEMS)
    bad = {str(r) for r in brute(documents(), ITEMS) if r[4]}
    kept = decontaminate.decontaminate(docs, items)
    assert kept.schema == docs.schema and kept.count() == len(documents()) - len([r for r in brute(documents(), ITEMS) if r[4]]) and bad
    texts = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, remove="spans").collect()}
    assert texts[100] == "before  after" and texts[101] == "x " * 900 and texts[2] is None and texts[103] == "short two one"
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, items, remove="words")


def test_empty_tables(spark):
    assert decontaminate.scan_contamination(frame(spark, []), bench(spark, ITEMS)).count() == 0
    none = decontaminate.scan_contamination(frame(spark, documents()), bench(spark, [])).collect()
    assert len(none) == len(documents()) and not any(r.contaminated or r.n_hit for r in none)


def test_sql(spark, tiny):
    assert_same(registry.queries()["op6_decontaminate"], registry.oracle_sql()["op6_decontaminate"], spark, tiny)


def test_sql_with_white_space_of_all_kinds_and_an_item_without_id(spark, spaced_tables):
    assert_same(registry.queries()["op6_decontaminate"], registry.oracle_sql()["op6_decontaminate"], spark, spaced_tables)


def test_window_that_many_items_share(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 50)
    items = [(i, passage(60, 13) + f" own{i}") for i in range(300)]
    got = decontaminate.scan_contamination(frame(spark, [(1, passage(60, 13)), (2, passage(60, 13) + " own7")]), bench(spark, items), keep=["doc_id"]).collect()
    assert {r.doc_id: (r.n_hit, len(r["items"])) for r in got} == {1: (13, 300), 2: (14, 300)}
