"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from kpiwarden.llm import centroids, licenses, line_dedup, suffix_dedup
from kpiwarden.llm.byte_bpe import round_trip_report
from kpiwarden.llm.embedding_dedup import near_vectors
from kpiwarden.llm.fingerprints import fingerprint_report
from kpiwarden.llm.importance import resampled
from kpiwarden.llm.jaccard_join import similar_documents
from kpiwarden.llm.language_id import predicted_languages
from kpiwarden.llm.packing import packed_documents
from kpiwarden.llm.quality import quality_scores
from kpiwarden.llm.substring_dedup import removal_report


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packed_documents(_table(spark, sf_dir, "documents"), path)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.site_line_report(_table(spark, sf_dir, "pages"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip_report(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted_languages(_table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(_table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered_vectors(_table(spark, sf_dir, "embeddings"))


_QUERIES = (
    op1_jaccard_join,
    op2_best_fit_packing,
    op3_substring_dedup,
    op4_line_dedup,
    op5_byte_bpe,
    op6_language_id,
    op7_license_scan,
    op8_quality,
    op9_embedding_dedup,
    op10_fingerprints,
    op11_importance_resampling,
    op12_suffix_array_dedup,
    op13_centroid_clustering,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_dedup": line_dedup.ORACLE_SQL,
        "op7_license_scan": licenses.oracle_sql(),
        "op13_centroid_clustering": centroids.oracle_sql(),
    }
