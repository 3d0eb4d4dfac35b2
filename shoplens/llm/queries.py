"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import oracle
from shoplens.llm.bpe_trie import encode_digests
from shoplens.llm.common import load
from shoplens.llm.conversation_repair import damage, repair_conversations, repair_digests
from shoplens.llm.exact_dedup import exact_duplicates
from shoplens.llm.license_scan import license_digest, scan_licenses
from shoplens.llm.line_quality import line_quality
from shoplens.llm.mixing import mixed_sizes
from shoplens.llm.near_dedup import near_duplicates
from shoplens.llm.ngram_join import ngram_components
from shoplens.llm.quality_classifier import score_quality
from shoplens.llm.spelling_variants import LOSES, spelling_variants, vocabulary
from shoplens.llm.token_counts import count_tokens
from shoplens.llm.token_output import token_positions
from shoplens.llm.toxicity import score_toxicity

WORD_BPE = "word_bpe_49k.json"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(load(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(scan_licenses(load(spark, sf_dir, "documents")))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_positions(load(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(load(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), shingle_words=4)


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(load(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(load(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations")
    return repair_digests(rows, repair_conversations(damage(rows), "conv", "turn").withColumnRenamed("conv", "conv_id"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(load(spark, sf_dir, "documents"), loses=LOSES))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(load(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_toxicity, op2_token_counts, op3_exact_dedup, op4_license_scan, op5_token_files, op6_line_quality,
        op7_near_dedup, op8_bpe_round_trip, op9_source_mix, op10_quality_classifier, op11_conversation_repair,
        op12_spelling_variants, op13_ngram_join,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
