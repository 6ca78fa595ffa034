import hashlib

import numpy as np
import pytest

import corpus_pipeline as P
from tidewell.llm import bpe, pii
from tests.llm.helpers import awkward, passage
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_neardup import brute as groups


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    item = passage(50, 40)
    rows = awkward() + [(100 + i, passage(900 + i, 40 + i)) for i in range(60)]
    rows += [(200, "a " + item), (201, passage(900, 40) + " tail"), (202, passage(31, 30) + " me@mail.example.com " + passage(32, 9))]
    rows += [(300 + i, passage(2000 + i, 50) + " vile rotten nasty" + (" vile awful" * 3)) for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(100 + i, 1, 0) for i in range(60)] + [(300 + i, 0, 1) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_each_stage_does_its_work_on_what_came_before(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    schema = docs.schema
    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, tables)
        out.write.parquet(f"file://{tmp_path}/{name}")
        out = spark.read.parquet(f"file://{tmp_path}/{name}")
        seen[name] = (docs, out)
        if name != P.STAGES[-1][0]:
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schema]
        docs = out

    before, after = seen["toxicity"]
    kept = {i for i, _ in rows_of(after)}
    assert not kept & set(range(300, 340)) and set(range(100, 160)) <= kept
    assert len([i for i, _ in rows_of(after) if i is None]) == 2

    before, after = seen["near_duplicates"]
    want = {i for i, _, _, keep in groups(rows_of(before), 5) if keep and i is not None}
    ids = [i for i, _ in rows_of(after)]
    assert {i for i in ids if i is not None} == want and len(ids) == len(want) + 2

    before, after = seen["decontamination"]
    bad = {i for i, _, _, _, hit in contamination(rows_of(before), [(1, passage(50, 40))]) if hit}
    assert 200 in bad and {i for i, _ in rows_of(before)} - bad == {i for i, _ in rows_of(after)}

    before, after = seen["personal_data"]
    for r in after.collect():
        assert not pii.base_spans(r.text or "") and r.n_chars == (None if r.text is None else len(r.text))
    assert "[EMAIL]" in dict(rows_of(after))[202] and before.count() == after.count()

    before, after = seen["tokens"]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    texts = dict(rows_of(before))
    for r in after.collect():
        if r.doc_id is not None:
            ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
            assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == ids and r.n_tokens == len(ids)
            assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_on_test_tables(spark, tiny):
    found = P.run(spark, tiny)
    n = spark.read.parquet(f"{tiny}/documents.parquet").count()
    assert 0.5 * n < found.count() < n and found.columns[0] == "doc_id"


def test_empty_documents(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, tables)
    assert docs.count() == 0


def test_without_labels_no_document_is_toxic(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    spark.read.parquet(f"{tables}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert sorted(map(str, rows_of(P.drop_toxic(spark, docs, str(tmp_path))))) == sorted(map(str, rows_of(docs)))


def test_oracle_is_none():
    assert P.ORACLE_SQL is None and len(P.STAGES) == 5


def test_names_that_clash_and_rows_that_repeat(spark, tables):
    """Working columns of the stages leave columns of those names alone; of rows with one id and text the least stays."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    named = docs.selectExpr("*", "7 AS score", "'a' AS digest", "'b' AS turn", "concat('in', doc_id) AS in_text", "3.5D AS toxicity_score_", "map('k', 1) AS m")
    again = named.unionByName(named.where("doc_id BETWEEN 100 AND 120").selectExpr("doc_id", "text", "'de' AS lang", "source", "n_chars", "score", "digest", "turn", "in_text", "toxicity_score_", "m"))
    for stage in (P.drop_toxic, P.drop_near_duplicates, P.drop_contaminated, P.redact_personal_data):
        again = stage(spark, again, tables)
        assert again.columns == named.columns
        rows = again.collect()
        assert rows and all((r.score, r.digest, r.turn, r.toxicity_score_, r.m) == (7, "a", "b", 3.5, {"k": 1}) and r.in_text == (None if r.doc_id is None else f"in{r.doc_id}") for r in rows)
        again = spark.createDataFrame(rows, again.schema)
    kept = {r.doc_id: r.lang for r in rows}
    assert all(kept[i] == "de" for i in kept if i and 100 <= i <= 120) and len([r for r in rows if r.doc_id == 110]) == 1
