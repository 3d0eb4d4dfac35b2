"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from oracle_sql import oracle_queries
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    # the training-data queries are tested in tests/llm
    extra = {n for n in E.queries() if n == "pipeline" or re.match(r"op\d+_", n)}
    assert set(oracle_queries()) == set(E.queries()) - extra


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_queries()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(df.columns, rows) == _canon(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns[0] == "session_count"
    assert os.path.isdir(SF_SMALL)
