"""Cleaning a corpus and packing it: quality, exact and near duplicates, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and gives a frame that is written as Parquet and read as
the next one's ``docs``; all but the last give the columns of documents, extra ones included.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldkit.llm import exact_dedup, packing, pii, quality, simhash
from fieldkit.session import settle

VOCABULARY = "byte_bpe_50k.json"
SEQUENCE_TOKENS = 1024

# The stages are a trained classifier, hashes and a tokenizer that SQL does not have.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, trained on this folder's labels, rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.good_documents(docs, quality.learn(docs, labels))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.exact_survivors(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints."""
    return simhash.near_survivors(docs, shingle=3, radius=2)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts masked."""
    return pii.without_personal_data(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document lies in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), SEQUENCE_TOKENS)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", keep_one_copy),
    ("simhash_near_dedup", keep_one_of_near),
    ("pii", mask_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
