"""A training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; ``run``
writes every stage as Parquet to the shared folder and reads it back as the next
one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stallwise.llm import decontaminate, queries, sentencepiece_bpe, simhash, toxicity
from stallwise.sources.staging import new_path


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the severity that is rejected."""
    model = queries.toxicity_model(spark, sf_dir, docs)
    return toxicity.without_toxic(docs, model, reject_from=queries.REJECT_FROM)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest id."""
    return simhash.one_per_component(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.without_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of whole texts, begin and end included, with digests of the ids and of the decoded text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_bpe.encoded_digests(docs, model, keep_ids=True)


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_contaminated),
    ("sentencepiece encoding", encode),
]

# Regression, fingerprints and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage_of in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        stage_of(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
