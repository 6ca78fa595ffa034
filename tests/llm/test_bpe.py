import hashlib
import random

import numpy as np
import pytest

from tidewell.llm import bpe, registry
from tests.llm.helpers import awkward, frame


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


def test_tree_concatenation_is_exact(library):
    small = bpe.Codec(bpe.default_vocabulary(), leaf=4, long_run=8)
    usual = bpe.Codec(bpe.default_vocabulary())
    r = random.Random(5)
    for _ in range(1500):
        letters = r.choice(["ab", "the", "inthanre", "abcdefghij", "ab1!é", "éèàßİΣ", "x́e", "日本語a", "'sre", "a\x1c\x85\xa0\xad"])
        text = "".join(r.choice(letters) for _ in range(r.randint(1, 150)))
        if r.random() < 0.2:
            text = text.replace("a", r.choice(["<|endoftext|>", "<|startoftext|>", "<|"]))
        want = library.encode(text, add_special_tokens=False).ids
        assert small.long_text(text) == want, text
        runs = [x for x in __import__("re").split("[ \t-\r]+", text) if x]
        assert np.frombuffer(b"".join(usual.runs(runs)), "<u4").tolist() == want, text


def test_a_very_long_unsplit_text(library):
    text = "".join(random.Random(1).choice("aeioustn") for _ in range(60_000))
    assert bpe.Codec(bpe.default_vocabulary()).long_text(text) == library.encode(text, add_special_tokens=False).ids


def test_encode_and_decode_in_spark(spark, library):
    rows = awkward() + [(20, "q" * 5000 + " <|endoftext|>x<|startoftext|>"), (21, "a\x1cb c​d")]
    path = bpe.default_vocabulary()
    done = bpe.decode(bpe.encode(frame(spark, rows).withColumnRenamed("n_words", "token_ids"), path), path)
    assert {"token_ids", "decoded", "lang", "score"} <= set(done.columns)
    for r in done.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(frame(spark, []), path), path).count() == 0


def test_query_against_the_library(spark, tiny, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    for r in registry.queries()["op2_bpe"](spark, tiny).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_and_decode_in_one_pass(spark, tiny, library):
    rows = awkward() + [(20, "q" * 5000 + " <|endoftext|>x<|startoftext|>"), (21, "a\x1cb c​d")]
    path = bpe.default_vocabulary()
    docs = frame(spark, rows).withColumnRenamed("n_words", "token_ids").withColumnRenamed("spans", "decoded")
    both = bpe.encode(docs, path, decoded="decoded")
    assert sorted(both.columns) == sorted(docs.columns)
    for r in both.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    in_turn = bpe.decode(bpe.encode(docs, path), path)
    assert sorted(map(repr, both.select(sorted(both.columns)).collect())) == sorted(map(repr, in_turn.select(sorted(both.columns)).collect()))
    assert bpe.encode(frame(spark, []), path, decoded="decoded").count() == 0


def test_a_task_of_the_query_waits_for_one_python_worker(spark, tiny):
    plan = registry.queries()["op2_bpe"](spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_refuses_other_models():
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("kind", ["Metaspace", "ByteLevel", "none"])
def test_vocabularies_that_keep_white_space_are_refused(tmp_path, kind):
    """A text cut at white space would lose what these tokenizers make of it."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    letters = "abcdefghijklmnopqrstuvwxyzWé1.' \u2581\u0120"
    small = Tokenizer(models.BPE(vocab={c: i for i, c in enumerate(letters)}, merges=[]))
    if kind != "none":
        small.pre_tokenizer = pre_tokenizers.Metaspace() if kind == "Metaspace" else pre_tokenizers.ByteLevel(add_prefix_space=False)
    small.save(str(tmp_path / "small.json"))
    with pytest.raises(ValueError, match="white space"):
        bpe.Codec(str(tmp_path / "small.json"))
    assert bpe.Codec(bpe.default_vocabulary())
