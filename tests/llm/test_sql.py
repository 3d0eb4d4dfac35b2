"""Registered queries against their DuckDB statements, on the given tables and on rows of nulls, ties and repeats."""

from __future__ import annotations

import duckdb
import pytest

from shoplens.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.llm.test_conversation_repair import made_rows
from tests.llm.test_ngram_join import made
from tests.llm.test_spelling_variants import made as variants

NAMES = sorted(Q.oracle_sql())


def compare(spark, folder: str, name: str) -> int:
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')" if folder != SF_SMALL else f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    got = Q.queries()[name](spark, folder)
    want = con.execute(Q.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert set(columns) <= set(got.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr)
    return len(rows)


@pytest.mark.parametrize("name", NAMES)
def test_given_tables(spark, name):
    assert compare(spark, SF_SMALL, name)


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    texts = made(4)
    # equal texts keep one id each: which of two equal largest ids stays is not defined
    words = [(1000 + k, t) for k, (_, t) in enumerate(variants(3, 60))]
    docs = [(i, t, "en", "s", 0) for i, t in texts + words if i is not None]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    talks = [r[:4] for r in made_rows(40, 8)]
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd_tables, name):
    assert compare(spark, odd_tables, name)
