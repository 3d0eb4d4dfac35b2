"""Area top-3 product job: one logical plan from scan to ranking."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from shoplens.operators import products as P
from shoplens.params import TaskParams
from shoplens.sinks.writers import with_task_id
from shoplens.sources.tables import city_dimension, click_product_pairs


def build(
    actions: DataFrame,
    products: DataFrame,
    params: TaskParams,
    cities: DataFrame | None = None,
    levels: dict[str, list[str]] | None = None,
) -> DataFrame:
    """``area, areaLevel, productid, cityInfos, clickCount, productName, productStatus``.

    ``cities`` defaults to the reference's inline 10-row relation (broadcast,
    its size is fixed); a caller-supplied city table is joined by size.
    """
    spark = actions.sparkSession
    inline = cities is None
    cities = city_dimension(spark) if inline else cities
    counts = P.area_product_counts(click_product_pairs(actions, params), cities, broadcast_cities=inline)
    return P.area_top3_products(counts, products, levels=levels)


def build_sql(
    spark,
    params: TaskParams,
    levels: dict[str, list[str]] | None = None,
    actions_view: str = "user_visit_action",
    cities_view: str = "city_info",
    products_view: str = "product_info",
) -> DataFrame:
    """The same job in Spark SQL over registered views (the reference's form).

    Needs :func:`shoplens.functions.sql.register_sql_functions` and the three
    views.  Catalyst plans it exactly like :func:`build` (pushed date filter,
    partial aggregation, per-area partial top-3).
    """
    levels = P.REFERENCE_AREA_LEVELS if levels is None else levels
    cases = " ".join(
        "WHEN area IN (" + ", ".join("'" + a.replace("'", "''") + "'" for a in names) + f") THEN '{lvl}'"
        for lvl, names in levels.items()
    )
    return spark.sql(
        f"""
        WITH clicks AS (
          SELECT city_id, click_product_id AS product_id FROM {actions_view}
          WHERE click_product_id IS NOT NULL AND click_product_id != -1
            AND date >= :start_date AND date <= :end_date
        ),
        city_product AS (
          SELECT city_id, product_id, count(*) AS n FROM clicks GROUP BY city_id, product_id
        ),
        area_product AS (
          SELECT ci.area, c.product_id, sum(c.n) AS click_count,
                 array_join(array_sort(collect_set(concat_cid_cname(c.city_id, ci.city_name, '='))), ',')
                   AS city_infos
          FROM city_product c JOIN {cities_view} ci ON c.city_id = ci.city_id
          GROUP BY ci.area, c.product_id
        ),
        with_info AS (
          SELECT ap.*, pi.product_name,
                 IF(trim(json_field(pi.extend_info, 'product_status')) = '0', 'SELF', 'Third Party')
                   AS product_status,
                 row_number() OVER (PARTITION BY ap.area ORDER BY ap.click_count DESC, ap.product_id) AS rn
          FROM area_product ap JOIN {products_view} pi ON ap.product_id = pi.product_id
        )
        SELECT area, CASE {cases} ELSE 'D' END AS areaLevel, product_id AS productid,
               city_infos AS cityInfos, click_count AS clickCount, product_name AS productName,
               product_status AS productStatus
        FROM with_info WHERE rn <= 3
        """,
        args={"start_date": params.start_date, "end_date": params.end_date},
    )


def run(spark, actions: DataFrame, products: DataFrame, params: TaskParams, sink, task_id: str | None = None,
        **options) -> str:
    task_id = task_id or str(uuid.uuid4())
    sink.write("area_top3_product", with_task_id(build(actions, products, params, **options), task_id))
    return task_id
