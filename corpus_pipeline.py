"""Corpus pipeline: language ID, near-duplicate removal, benchmark
decontamination, secret redaction, BPE encoding and decoding.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes every stage's result as Parquet in the shared checkpoint folder
and reads it again as the next one's input; a stage's folder is removed when the
next one stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from domus.llm import bpe, common, decontaminate, jaccard, language, secrets
from domus.llm.tokens import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the language classifier does not reject."""
    return language.accepted(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near duplicates:
    five-word shingles, similarity 0.8 or more."""
    return jaccard.keep_one(docs, gram=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.keep_clean(docs, common.table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secrets.redact(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and the digests of ids and decoded text of every document."""
    return bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("BPE encoding and decoding", encode_bpe),
]

#: classification, redaction and BPE have no SQL form; tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, done = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), common.shared_dir(spark, name.replace(" ", "-"))
        out.write.parquet(path)
        if done:
            common.remove_folder(spark, done)
        docs, done = spark.read.schema(out.schema).parquet(path), path
    return docs
