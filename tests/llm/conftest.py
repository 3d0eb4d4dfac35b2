from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shoplens.llm.common import prepare

#: Nulls, empties, ties, repeats, odd characters, and columns that operators use as names.
SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        StructField("id", StringType()),
        StructField("row", StringType()),
        StructField("print", StringType()),
        StructField("score", StringType()),
        StructField("size", StringType()),
        StructField("keep_id", StringType()),
    ]
)

LONG = " ".join(f"word{i % 977} x{i}" for i in range(30_000))
BASE = " ".join(f"alpha{i}" for i in range(100))
TEXTS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t  ", None),
    (4, BASE, "b"),
    (5, BASE, "b"),
    (5, BASE, "b"),
    (6, BASE.replace("alpha50", "beta"), "b"),
    (7, BASE.replace("alpha50", "beta").replace("alpha7 ", "beta "), None),
    (8, "Two words", "a"),
    (9, "two WORDS", "a"),
    (None, "no id MIT License", "c"),
    (None, "no id MIT License", "c"),
    (10, LONG, "c"),
    (11, "It's <|endoftext|>x 123 naïve İstanbul é ﬁ 你好 'tis O×k <|startoftext|", "a"),
    (12, "line one here now\nline one here now\nthe MIT-license; Apache License, General Public License", "b"),
    (13, "x" * 5000 + " tail", "a"),
    (14, "ÉTÉ ßÿ ½ º \x1f \x0b 　 a--b...c!?", ""),
]


@pytest.fixture(scope="session")
def rows():
    return [(i, t, "en", s, 7, "i", "r", "p", "s", "z", "k") for i, t, s in TEXTS]


@pytest.fixture(scope="session")
def docs(spark, rows):
    prepare(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
