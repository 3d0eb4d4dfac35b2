from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql.types import LongType, StructField, StructType  # noqa: E402

from shoplens.schemas import USER_INFO, USER_VISIT_ACTION  # noqa: E402
from shoplens.sources.tables import prepare_actions  # noqa: E402
from shoplens.spark import DEFAULT_CONF  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("shoplens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.local.dir", str(tmp_path_factory.mktemp("spark-local")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder; a cluster names a shared one
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield session
    session.stop()


ACTION_DEFAULTS = {
    "date": "2024-01-01",
    "user_id": 1,
    "session_id": "s1",
    "page_id": 1,
    "action_time": "2024-01-01 0:00:00",
    "search_keyword": None,
    "click_category_id": -1,
    "click_product_id": -1,
    "order_category_ids": None,
    "order_product_ids": None,
    "pay_category_ids": None,
    "pay_product_ids": None,
    "city_id": 0,
}


def make_actions(spark, rows: list[dict]):
    """Actions in the reference's schema; ``tie`` = row position."""
    data = []
    for i, r in enumerate(rows):
        full = {**ACTION_DEFAULTS, **r}
        data.append(tuple(full[f.name] for f in USER_VISIT_ACTION.fields) + (i,))
    schema = StructType(USER_VISIT_ACTION.fields + [StructField("tie", LongType())])
    return prepare_actions(spark.createDataFrame(data, schema))


def make_users(spark, rows: list[tuple]):
    """(user_id, age, professional, city, sex) tuples."""
    data = [(u, f"user{u}", f"name{u}", a, p, c, s) for u, a, p, c, s in rows]
    return spark.createDataFrame(data, USER_INFO)


def sorted_rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()]
