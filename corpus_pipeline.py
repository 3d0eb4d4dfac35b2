"""The corpus pipeline: quality, exact and near duplicates, mixing, tokens.

Every stage works on all rows its predecessor kept; its result is written as
Parquet to the shared folder and read again, so a lost executor costs only the
running stage; earlier results are then deleted.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shoplens.llm.bpe_trie import encode_documents
from shoplens.llm.common import discard, load, prepare, scratch, shared_folder
from shoplens.llm.exact_dedup import drop_duplicates
from shoplens.llm.mixing import mix
from shoplens.llm.near_dedup import drop_near_duplicates
from shoplens.llm.quality_classifier import keep_good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; it learns from the labelled rows of this stage's input."""
    return keep_good(docs, load(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    prepare(spark)
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the document with the smallest id."""
    prepare(spark)
    return drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per epoch of each document the mix takes."""
    prepare(spark)
    return mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, the ids of each text and what they decode to."""
    prepare(spark)
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), decoded_col="decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("bpe encoding", bpe_encoding),
]

#: The classifier's trees, the sketches and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_folder(spark, name.replace(" ", "-"))
        # what a stage needs on its way goes when its result is written, and then what it read
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
