"""A training corpus from ``documents``: toxicity, near duplicates, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's docs.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm import bpe, decontaminate, neardup, pii, toxicity
from tidewell.llm.runtime import read, shared_folder
from tidewell.plans.store import Files


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney models score below 0.5.

    Models and curve learn from labels outside op7's held-out fifth.  Null and
    blank texts have no evidence against them and stay, as do all documents
    where no label could fit a curve.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), training=~toxicity.held_out("id"))
    if not model.curve.any():
        return docs
    # Under other names, so that no column of the documents clashes with the score.
    renamed = docs.select(*[docs[c].alias(f"in_{c}") for c in docs.columns])
    clean = toxicity.score(renamed, model, text="in_text").where("score < 0.5")
    return clean.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: Jaccard 0.8 or more on shingles of five words.

    Rows without a doc_id stay.  Rows that share a doc_id stay if one of them
    does, but of rows that share doc_id and text one stays, the least by its
    other columns.
    """
    kept = neardup.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    own = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").select(*[docs[c].alias(f"in_{c}") for c in docs.columns])
    rest = [F.col(f"in_{f.name}") for f in docs.schema if f.name not in ("doc_id", "text") and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    # The join has brought equal ids together; digests spare the sort from comparing texts.
    turn = F.row_number().over(Window.partitionBy("in_doc_id", "digest").orderBy(*(rest or ["digest"])))
    once = own.withColumn("digest", F.md5(F.col("in_text").cast("string"))).withColumn("turn", turn).where("turn = 1")
    return once.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns]).unionByName(docs.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which windows of benchmark items cover less than a twentieth of the words."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"), remove="documents")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data replaced by its kind in brackets; n_chars follows the text."""
    clean = pii.redact(docs, pii.train(docs))
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids (packed little-endian unsigned 32-bit), decoded_sha256."""
    path = bpe.default_vocabulary()
    encoded = bpe.encode(docs, path, keep=["doc_id", "lang", "source"])
    done = bpe.decode(encoded, path)
    return done.select("doc_id", "lang", "source", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("tokens", tokenize),
]

#: Learned scores, classifiers and a tokenizer: SQL can't express these stages; tests hold brute force against them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.

    Stages are written to the session's shared checkpoint folder; a stage's
    files go once the next stage is written, so two copies exist at most.
    """
    files = Files(spark)
    folder = f"{shared_folder(spark)}/corpus_pipeline"
    docs = read(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            files.delete(before)
        before = f"{folder}/{name}"
    return docs
