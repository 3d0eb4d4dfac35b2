"""Batch sources: table loading, date-ranged action scans, dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.columns import parse_action_time
from shoplens.params import TaskParams
from shoplens.schemas import CITY_INFO


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet`` if ``root`` is a folder, else a catalog table."""
    if root:
        return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return spark.table(name)


def present_id(col: Column) -> Column:
    """A click id is absent when null or the sentinel -1 (Q4)."""
    return col.isNotNull() & (col != F.lit(-1))


def prepare_actions(actions: DataFrame) -> DataFrame:
    """Add the typed columns every job works on.

    * ``action_ts``: parsed ``action_time`` (unpadded hours accepted, Q10);
    * ``tie``: a deterministic tie-break for actions with equal times.  A
      source that has a unique id supplies it; otherwise a hash of the row.
    """
    out = actions
    if "action_ts" not in out.columns:
        out = out.withColumn("action_ts", parse_action_time(F.col("action_time")))
    if "tie" not in out.columns:
        out = out.withColumn("tie", F.xxhash64(*[F.col(c) for c in actions.columns]))
    return out


def actions_in_range(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Actions whose ``date`` is inside the task range (both ends).

    The predicate is on a scan column, so it reaches the parquet reader as a
    pushed filter (and prunes ``date`` partitions of a partitioned table).
    """
    return actions.where(params.date_predicate("date"))


def click_product_pairs(actions: DataFrame, params: TaskParams) -> DataFrame:
    """S3: (city_id, product_id) of product clicks inside the date range."""
    return (
        actions_in_range(actions, params)
        .where(present_id(F.col("click_product_id")))
        .select("city_id", F.col("click_product_id").alias("product_id"))
    )


def user_dimension(users: DataFrame) -> DataFrame:
    """The user attributes the session filter needs (pruned early)."""
    return users.select("user_id", "age", "professional", "city", "sex")


def product_dimension(products: DataFrame) -> DataFrame:
    """S5."""
    return products.select("product_id", "product_name", "extend_info")


# Fixed values that must equal the reference's: the inline city relation
# (city id, city name, area).
REFERENCE_CITIES = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]


def city_dimension(spark: SparkSession) -> DataFrame:
    """The 10-row inline city/area relation."""
    return spark.createDataFrame(REFERENCE_CITIES, CITY_INFO)
