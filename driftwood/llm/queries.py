"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    centroids,
    decontaminate,
    exact_dedup,
    hilbert_neighbours,
    license_scan,
    lm_score,
    ngram_join,
    periodic_runs,
    quality,
    secrets,
    sentencepiece_codec,
    substring_dedup,
    url_filter,
)
from .common import table

#: Where the tokenizer's model lies; a parameter of the query, read once by the driver.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    return sentencepiece_codec.query(table(spark, sf_dir, "documents"), sentencepiece_codec.read_model(model_path))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.query(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.query(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.query(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.query(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.query(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.query(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.query(table(spark, sf_dir, "pages"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.query(table(spark, sf_dir, "embeddings"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_neighbours.query(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.query(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_sentencepiece, op2_license_scan, op3_secret_scan, op4_quality, op5_decontaminate, op6_lm_score, op7_ngram_join,
    op8_substring_dedup, op9_exact_dedup, op10_url_filter,
    op11_centroid_clustering, op12_nearest_neighbours, op13_periodic_runs)}

SQL: dict[str, str] = {"op5_decontaminate": decontaminate.SQL, "op8_substring_dedup": substring_dedup.SQL,
                       "op9_exact_dedup": exact_dedup.SQL, "op10_url_filter": url_filter.SQL,
                       "op11_centroid_clustering": centroids.SQL, "op12_nearest_neighbours": hilbert_neighbours.SQL,
                       "op13_periodic_runs": periodic_runs.SQL}
