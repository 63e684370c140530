"""The corpus pipeline: toxic documents go, near-duplicates go, secrets are masked, sources are mixed, texts are encoded.

Each stage reads all that its predecessor kept, written as Parquet. The first four return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from probity.llm import bpe, mixing, secret_scan, simhash, toxicity
from probity.llm.common import read, shared_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score less than one half."""
    model = toxicity.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 4-word shingles, fingerprints linked at 4 bits or fewer."""
    return simhash.deduplicated(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets masked."""
    return secret_scan.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text; a document that the mix repeats has a row for each time."""
    return bpe.digest(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: SQL can express neither the toxicity model nor the tokenizer; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written under the shared checkpoint folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
