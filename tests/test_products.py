"""Area top-3 products (J8, A10, J9, P12, P13, W1; Q3, Q24)."""

from __future__ import annotations

from shoplens.operators import products as P
from shoplens.schemas import PRODUCT_INFO
from shoplens.sources.tables import city_dimension


def _clicks(spark, pairs):
    return spark.createDataFrame(pairs, "city_id bigint, product_id bigint")


def test_city_list_is_exact_distinct(spark):
    cities = spark.createDataFrame([(1, "X", "north"), (11, "X", "north")], "city_id bigint, city_name string, area string")
    counts = P.area_product_counts(_clicks(spark, [(11, 5), (1, 5), (1, 5)]), cities)
    row = counts.collect()[0]
    # the reference's substring de-dup would drop "1=X" after "11=X" (Q3)
    assert row.city_infos == "11=X,1=X"  # both kept, sorted as text
    assert row.click_count == 3


def test_top3_per_area_with_status_and_levels(spark):
    clicks = [(0, 1)] * 5 + [(0, 2)] * 4 + [(1, 3)] * 4 + [(0, 4)] * 1 + [(9, 5)] * 2 + [(0, 6)] * 9
    products = spark.createDataFrame(
        [
            (1, "p1", '{"product_status": 0}'),
            (2, "p2", '{"product_status": 1}'),
            (3, "p3", "{}"),
            (4, "p4", '{"product_status": "x"}'),
            (5, "p5", None),
        ],
        PRODUCT_INFO,
    )
    counts = P.area_product_counts(_clicks(spark, clicks), city_dimension(spark), broadcast_cities=True)
    top = P.area_top3_products(counts, products)
    got = sorted((r.area, r.areaLevel, r.productid, r.clickCount, r.productStatus) for r in top.collect())
    # product 6 has no product row: not ranked (inner join, as the reference)
    assert got == [
        ("东北", "D", 5, 2, "Third Party"),
        ("华东", "A", 3, 4, "Third Party"),
        ("华北", "A", 1, 5, "SELF"),
        ("华北", "A", 2, 4, "Third Party"),
        ("华北", "A", 4, 1, "Third Party"),
    ]


def test_ties_broken_by_product_id(spark):
    clicks = [(0, p) for p in (9, 8, 7, 6)]
    products = spark.createDataFrame([(p, f"p{p}", '{"product_status": 0}') for p in (6, 7, 8, 9)], PRODUCT_INFO)
    counts = P.area_product_counts(_clicks(spark, clicks), city_dimension(spark))
    assert sorted(r.productid for r in P.area_top3_products(counts, products).collect()) == [6, 7, 8]


def test_custom_levels(spark):
    df = spark.createDataFrame([("ASIA",), ("EUROPE",), ("MARS",)], "area string")
    got = [r[0] for r in df.select(P.area_level(df.area, {"A": ["EUROPE"], "B": ["ASIA"]})).collect()]
    assert got == ["B", "A", "D"]
