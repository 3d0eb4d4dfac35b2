"""Leading products per area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.columns import concat_id_name, distinct_joined, json_field
from shoplens.sources.tables import product_dimension

# Fixed values that must equal the reference's: area name -> level.
# Any other area is level D.
REFERENCE_AREA_LEVELS = {
    "A": ["华北", "华东"],
    "B": ["华南", "华中"],
    "C": ["西北", "西南"],
}


def area_level(area, levels: dict[str, list[str]] | None = None):
    """CASE area -> A/B/C, else D."""
    levels = REFERENCE_AREA_LEVELS if levels is None else levels
    expr = None
    for level, names in levels.items():
        cond = area.isin(names)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return F.lit("D") if expr is None else expr.otherwise(F.lit("D"))


def product_status(extend_info):
    """``SELF`` when ``product_status`` is 0, else ``Third Party``.

    Compared as text, so a missing or non-numeric status is simply not 0
    (Q24) instead of an error.
    """
    status = F.trim(json_field(extend_info, "product_status"))
    return F.when(status == F.lit("0"), F.lit("SELF")).otherwise(F.lit("Third Party"))


def area_product_counts(clicks: DataFrame, cities: DataFrame, broadcast_cities: bool = False) -> DataFrame:
    """J8 + A10: clicks and distinct ``city_id=city_name`` list per (area, product).

    ``clicks``: ``city_id, product_id``.  Clicks are counted per (city,
    product) first, so the city join and the list see one row per city and
    product instead of one per click.  The list is exact and sorted (Q3),
    bounded by the number of cities of an area.  ``broadcast_cities`` is for a city relation of fixed
    size (the inline 10-row one); otherwise the planner decides from its
    size statistics.
    """
    dim = cities.select("city_id", "city_name", "area")
    if broadcast_cities:
        dim = F.broadcast(dim)
    per_city = clicks.groupBy("city_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return per_city.join(dim, "city_id").groupBy("area", "product_id").agg(
        F.sum("n").alias("click_count"),
        distinct_joined(concat_id_name(F.col("city_id"), F.col("city_name"))).alias("city_infos"),
    )


def area_top3_products(
    counts: DataFrame, products: DataFrame, n: int = 3, levels: dict[str, list[str]] | None = None
) -> DataFrame:
    """J9 + W1 + P12: top ``n`` products per area by clicks (ties: product id).

    Inner join with the product table first (a product without a product
    row is not ranked, as in the reference), then ``row_number() <= n``,
    which Spark pre-limits per task before the window shuffle.
    """
    info = product_dimension(products).select(
        "product_id", "product_name", product_status(F.col("extend_info")).alias("product_status")
    )
    w = Window.partitionBy("area").orderBy(F.desc("click_count"), F.asc("product_id"))
    ranked = counts.join(info, "product_id").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    return ranked.select(
        "area",
        area_level(F.col("area"), levels).alias("areaLevel"),
        F.col("product_id").alias("productid"),
        F.col("city_infos").alias("cityInfos"),
        F.col("click_count").alias("clickCount"),
        F.col("product_name").alias("productName"),
        F.col("product_status").alias("productStatus"),
    )
