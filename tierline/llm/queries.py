"""The registered queries of this subpackage: one per operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import alignment, ann_search, bpe_codec, jaccard_join, language_id, license_scan, lm_score, packing, quality, suffix_dedup, token_counts, vector_dedup, whitening
from tierline.llm.common import table

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(table(spark, sf_dir, "documents"))


def op3_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.held_out_scores(table(spark, sf_dir, "documents"))


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.train_and_identify(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.budget(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe_codec, op2_license_scan, op3_ann_search, op4_lm_score, op5_vector_dedup,
        op6_language_id, op7_quality, op8_jaccard_join, op9_token_counts, op10_packing,
        op11_whitening, op12_suffix_dedup, op13_alignment,
    )
}

#: DuckDB SQL by query, where SQL can express it.
ORACLE: dict[str, str] = {}
