"""Cleaning a text corpus for training: five stages, each over all rows that the one before kept.

Toxic documents go, exact copies go, one document of each group of near copies stays, documents that hold a benchmark
item go, and the rest is encoded. All but the last stage return the columns of documents.

Every stage takes any table with these columns, and further ones of any name, which it passes on (the last one doesn't).
Null texts count as empty. An empty table gives an empty one. Rows may repeat; a null doc_id is a key smaller than all
others. Very long texts are read whole.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall.llm import bpe, decontaminate, exact, near, queries, toxicity  # noqa: E402
from rollcall.llm.common import keep_table, text_of  # noqa: E402


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score at or above the cut of their language. Learns from the labels of this input. Without
    labels of both kinds the score is constant: 0, so that all stay, or 1 where only toxic documents are known. Rows that
    repeat share their score."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, queries.table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id; one of them where it repeats. Null and empty texts are equal."""
    return exact.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the smallest doc_id. Texts without a word are no copies of anything."""
    return near.without_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a copy of a benchmark item. Rows of one doc_id, null included, go together."""
    return decontaminate.without_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the packed token ids of each document; every text's ids are decoded again, and
    ids that don't give its bytes would fail the job. An empty or null text has no ids."""
    words = queries.vocabulary()
    coded = docs.withColumn("packed", bpe.encode(spark, words, text_of("text"), verify=True))
    tokens = bpe.n_tokens(F.col("packed")).alias("n_tokens")
    return coded.select("doc_id", "lang", "source", tokens, F.col("packed").alias("ids"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("byte_bpe", encoding_stage),
]

#: SQL has no trained classifier, no near copies by chosen paths and no BPE; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written as a table and read again as the next one's input."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep_table(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
