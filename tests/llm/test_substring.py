import random
import re

import pytest

from tidewell.llm import registry, substring
from tests.llm.helpers import awkward, frame, passage
from tests.oracle import assert_same

W = 13


def brute(rows, window=W):
    words = [re.findall(r"[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        if i is not None:
            for a in range(len(w) - window + 1):
                k = tuple(w[a : a + window])
                first[k] = min(i, first.get(k, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for a in range(len(w) - window + 1):
            if i is not None and first[tuple(w[a : a + window])] < i:
                gone |= set(range(a, a + window))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def check(spark, rows, window=W, **options):
    got = [tuple(r) for r in substring.drop_repeats(frame(spark, rows), window=window, **options).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, window), key=str)


def test_awkward_rows(spark):
    check(spark, awkward())


def test_many_small_blocks_and_buckets(spark):
    shared = passage(9, 40)
    rows = [(i, passage(100 + i, 30) + " " + shared[i % 7 :] + " " + passage(300 + i % 5, 25)) for i in range(60)]
    check(spark, rows, block_bytes=2000, bucket_bytes=1500)


def test_buckets_that_go_to_files(spark):
    shared = passage(9, 80)
    rows = [(i, passage(i % 9, 30) + " " + shared + " " + passage(i, 20)) for i in range(40)]
    check(spark, rows, block_bytes=3000, bucket_bytes=10)


@pytest.mark.parametrize(("window", "mini", "letters", "sizes"), [(4, 2, "ab", (0, 12)), (4, 4, "abc", (0, 9)), (2, 1, "abcdef", (0, 6)), (13, 3, "ab", (10, 40)), (1, 1, "abcdefghij", (0, 4))])
def test_random_texts_of_few_words(spark, window, mini, letters, sizes):
    r = random.Random(window * 10 + mini)
    rows = [(r.randrange(50), " ".join(r.choice(letters) for _ in range(r.randint(*sizes)))) for _ in range(60)]
    check(spark, rows, window, mini=mini, block_bytes=150, bucket_bytes=r.choice([20, 400]))


def test_minimiser_size_is_checked(spark):
    with pytest.raises(ValueError):
        substring.drop_repeats(frame(spark, []), window=3, mini=4)


def test_windows_are_judged_on_the_input(spark):
    a, b = passage(1, 13), passage(2, 13)
    check(spark, [(1, a), (2, a + " " + b), (3, b)])


def test_empty_table(spark):
    assert substring.drop_repeats(frame(spark, [])).count() == 0


def test_colliding_hashes_fall_back_to_words():
    import numpy as np

    codes = np.array([0, 1, 0, 2], np.int32)
    assert not substring._twins_agree(np.array([5, 5], np.uint64), np.array([0, 2]), codes, 2)
    assert substring._beaten([np.array([1, 1, 2]), np.array([1, 1, 1])], np.array([9, 3, 1])).tolist() == [0]


def test_strings_with_one_hash_are_told_apart(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(substring._Block, "_sums", lambda self, hashes: np.zeros(len(self.starts), np.uint64))
    texts = [passage(1, 20), passage(2, 20), passage(1, 20), passage(2, 20)]
    block = substring._Block(pa.array([4, 3, 2, 1]), pa.array(texts), 13, 3, 1, np.zeros(0, np.uint64))
    words = lambda i: block.words.codes[block.starts[i] : block.starts[i] + block.spans[i]].tolist()
    for i, place in enumerate(block.place):
        assert words(i) == words(block.leaders[place])


def test_windows_in_files_with_one_hash_are_told_apart(monkeypatch):
    import numpy as np

    monkeypatch.setattr(substring, "rolling_hash", lambda hashes, size: np.zeros(len(hashes) - size + 1, np.uint64))
    texts = [passage(1, 14), passage(2, 13), passage(1, 14)]
    files = substring._Files(13)
    for i, t in enumerate(texts):
        own = substring._Strings.__new__(substring._Strings)
        own.body, own.starts = t + " ", np.arange(len(t.split()) - 12)
        own.ids = np.full(len(own.starts), i)
        files.add(own)
    assert files.bits().tolist() == [False, False, False, True, True]


def test_frequent_minimisers_come_last(spark):
    common = passage(77, 8)
    rows = [(i, " ".join(f"{passage(20 * i + k, 4)} {common}" for k in range(12))) for i in range(50)]
    docs = frame(spark, rows)
    found = substring._frequent(docs, 10**6, 40, 13, 3)
    assert 0 < len(found) < 100
    check(spark, rows + awkward(), block_bytes=4000, bucket_bytes=1000)


@pytest.mark.parametrize("name", ["op1_substring"])
def test_sql(name, spark, tiny):
    assert_same(registry.queries()[name], registry.oracle_sql()[name], spark, tiny)


def test_sql_splits_words_at_every_white_space(spark, spaced_tables):
    assert_same(registry.queries()["op1_substring"], registry.oracle_sql()["op1_substring"], spark, spaced_tables)
