"""From raw documents to packed training sequences, stage by stage.

Every stage takes what its predecessor kept and returns rows with the columns of
``documents``; the last returns where each piece of each document goes. A stage that
changes a text brings ``n_chars`` up to date.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiwarden.llm.jaccard_join import one_of_each
from kpiwarden.llm.line_dedup import drop_boilerplate
from kpiwarden.llm.packing import packed_documents
from kpiwarden.llm.quality import document_statistics, fit, keep_good
from kpiwarden.llm.substring_dedup import remove_repeats
from kpiwarden.sources.scratch import stored

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = fit(document_statistics(docs), labels)
    return keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source; copies, which are still there, count once."""
    return _counted(drop_boilerplate(docs, "text", "source", copies_once=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id.

    Rows that share both id and text are one document.
    """
    return one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has."""
    return _counted(remove_repeats(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of each piece of each document in sequences of 2048 tokens."""
    return packed_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("packing", packing),
]

#: SQL has neither the classifier nor the tokenizer; tests/llm compares with plain Python.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
