"""A corpus pipeline over ``documents``: quality classifier, exact dedup,
n-gram Jaccard join, benchmark decontamination, SentencePiece encoding.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``, reads all that its
predecessor kept and is written as Parquet before the next one reads it.  All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftwood.llm import decontaminate, exact_dedup, ngram_join, quality, sentencepiece_codec
from driftwood.llm.common import materialise, table
from driftwood.llm.queries import PIECE_MODEL


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects."""
    return quality.drop_rejected(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the one with the largest id."""
    return exact_dedup.keep_exact(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies keep the one with the smallest id."""
    return ngram_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids, of the decoded text and of the
    source spans of every document that is left."""
    return sentencepiece_codec.query(docs, sentencepiece_codec.read_model(PIECE_MODEL))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("sentencepiece encoding", sentencepiece_encoding),
]

#: The classifier's compression cannot be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
