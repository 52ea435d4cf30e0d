"""The registered queries of the operators here, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldkit.llm import (
    alignment,
    byte_bpe,
    embedding_dedup,
    exact_dedup,
    filter_audit,
    language_id,
    packing,
    pii,
    quality,
    secret_scan,
    simhash,
    source_mix,
    token_counts,
)

RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"
OTHER_VOCABULARY = "piece_bpe_32k.model"
TOKEN_LIMIT = 512
SEQUENCE_TOKENS = 1024
COSINE = 0.93
CACHED_PIECES = 600_000


class LlmQuery(NamedTuple):
    """A query over a folder of tables, and its SQL where there is one."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path(RANKS),
                               public_tokenizers.PATTERN)


def _secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    return found.drop("span_list")


def _exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents")).drop("span_list")


def _language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score_documents(docs, quality.learn(docs, table(spark, folder, "labels")))


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"), COSINE)


def _packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"),
                                  public_tokenizers.path(VOCABULARY), SEQUENCE_TOKENS,
                                  cached=CACHED_PIECES)


def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"),
                                     public_tokenizers.path(VOCABULARY), TOKEN_LIMIT)


def _source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.mix_sources(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def _alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.audit_alignment(
        table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY),
        public_tokenizers.path(OTHER_VOCABULARY))


def _filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, folder, "documents"),
                                      table(spark, folder, "labels"))


QUERIES: dict[str, LlmQuery] = {
    "op1_byte_bpe": LlmQuery(_byte_bpe),
    "op2_secret_scan": LlmQuery(_secrets),
    "op3_exact_dedup": LlmQuery(_exact_dedup, exact_dedup.exact_sql()),
    "op4_pii": LlmQuery(_pii),
    "op5_quality_classifier": LlmQuery(_quality),
    "op6_embedding_near_dedup": LlmQuery(_embeddings),
    "op7_best_fit_packing": LlmQuery(_packing),
    "op8_language_id": LlmQuery(_language_id),
    "op9_simhash_near_dedup": LlmQuery(_simhash),
    "op10_token_counts": LlmQuery(_token_counts),
    "op11_source_mix": LlmQuery(_source_mix, source_mix.mix_sql()),
    "op12_token_alignment": LlmQuery(_alignment),
    "op13_filter_audit": LlmQuery(_filter_audit, filter_audit.audit_sql()),
}
