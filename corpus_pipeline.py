"""A training-corpus pipeline: each stage works on all rows that the one before kept.

quality: documents the classifier rejects go. near_dedup: of each near-duplicate group
(five-word shingles) the smallest id stays. decontamination: documents with benchmark
passages go. secrets: confirmed secrets are masked in the text, and n_chars follows.
bpe: encodes the texts, and decodes the ids again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import bpe, decontaminate, near, quality, secrets
from waymark.llm.common import kept_table, table

# The tokenizer is a parameter of the operator; its file isn't part of the repository.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.kept_documents(spark, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(spark, docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secrets.masked_documents(spark, docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the whole text, their number, and the text decoded from them."""
    return bpe.encode_decode(docs, TOKENIZER)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("bpe", bpe_stage),
]

# The classifiers and the tokenizer can't be said in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order from ``documents``; what each returns is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
