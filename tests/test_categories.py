"""Golden cases for top categories and their sessions (U1, A4-A8, T1, W4, J4; Q5, Q8, Q9, Q22)."""

from __future__ import annotations

from shoplens.functions.columns import csv_to_ids
from shoplens.operators import categories as C
from shoplens.sources.adapters import DriverTables
from shoplens.spark import cut_lineage
from tests.conftest import SF_SMALL, make_actions, sorted_rows


def test_csv_ids_tolerate_trailing_comma_and_junk(spark):
    df = spark.createDataFrame([("1,2,",), ("",), (None,), ("3, x ,4",)], "s string")
    got = [r[0] for r in df.select(csv_to_ids(df.s)).collect()]
    assert got == [[1, 2], [], [], [3, 4]]


def test_counts_cover_click_order_pay(spark):
    acts = make_actions(
        spark,
        [
            {"click_category_id": 0},
            {"click_category_id": 3},
            {"click_category_id": 3},
            {"order_category_ids": "3,8,"},
            {"pay_category_ids": "8"},
            {"pay_category_ids": ""},
        ],
    )
    got = sorted_rows(C.category_counts(acts), "categoryid", "clickCount", "orderCount", "payCount")
    # category 8 is only ordered/paid, category 0 is a real click category
    assert got == [(0, 1, 0, 0), (3, 2, 1, 0), (8, 0, 1, 1)]


def test_strict_reference_mode_reproduces_q5(spark):
    acts = make_actions(
        spark,
        [
            {"click_category_id": 0},
            {"click_category_id": 3},
            {"order_category_ids": "8"},
            {"click_category_id": 4, "order_category_ids": "9"},
        ],
    )
    got = sorted(r.categoryid for r in C.category_counts(acts, strict_reference=True).collect())
    assert got == [3, 4, 9]


def test_top10_sort_and_ties(spark):
    rows = []
    # 12 categories; 10..11 tie with 9 on clicks, broken by orders/pays then id
    for cat in range(12):
        rows += [{"click_category_id": cat}] * (20 - cat if cat < 9 else 5)
    rows += [{"order_category_ids": "11"}]
    rows += [{"pay_category_ids": "10"}]
    acts = make_actions(spark, rows)
    top = C.top_categories(C.category_counts(acts)).collect()
    ids = [r.categoryid for r in top]
    assert ids == [0, 1, 2, 3, 4, 5, 6, 7, 8, 11]
    big = make_actions(spark, [{"click_category_id": 1}] * 3 + [{"order_category_ids": "2"}] * 2)
    # 64-bit counts compare in full (Q9): a plain descending sort
    assert [r.categoryid for r in C.top_categories(C.category_counts(big)).collect()] == [1, 2]


def test_top_sessions_per_category_and_duplicated_detail(spark):
    rows = []
    for s, n in [("s1", 3), ("s2", 2), ("s3", 2)]:
        rows += [{"session_id": s, "click_category_id": 1}] * n
    rows += [{"session_id": "s1", "click_category_id": 2}]
    acts = make_actions(spark, rows)
    top = C.top_categories(C.category_counts(acts))
    ts = C.top_sessions_per_category(acts, top, n=2)
    assert sorted_rows(ts, "categoryid", "sessionid", "clickCount") == [
        (1, "s1", 3),
        (1, "s2", 2),
        (2, "s1", 1),
    ]
    # Q8: s1 is in two lists: its 4 actions appear twice unless deduplicated
    assert C.top_session_actions(acts, ts).where("session_id = 's1'").count() == 8
    assert C.top_session_actions(acts, ts, dedupe=True).where("session_id = 's1'").count() == 4


def test_top_sessions_limit_with_many_sessions(spark):
    rows = [{"session_id": f"s{i:02d}", "click_category_id": 7} for i in range(30)]
    acts = make_actions(spark, rows)
    ts = C.top_sessions_per_category(acts, C.top_categories(C.category_counts(acts)))
    assert sorted(r.sessionid for r in ts.collect()) == [f"s{i:02d}" for i in range(10)]


def test_one_aggregate_feeds_both_rankings(spark):
    t = DriverTables(spark, SF_SMALL)
    acts = t.actions()
    counted = C.category_session_counts(acts)
    cols = ("categoryid", "clickCount", "orderCount", "payCount")
    for strict in (False, True):
        assert sorted_rows(C.category_totals(counted, strict), *cols) == sorted_rows(C.category_counts(acts, strict), *cols)
    top = C.top_categories(C.category_totals(counted))
    assert sorted_rows(C.rank_sessions(counted, top)) == sorted_rows(C.top_sessions_per_category(acts, top))


def test_top_sessions_join_the_actions_once(spark, tmp_path):
    """Both rankings read the materialised aggregate: neither plan has the actions or a second semi join of them."""
    t = DriverTables(spark, SF_SMALL)
    acts = t.actions()
    counted = cut_lineage(C.category_session_counts(acts.join(acts.select("session_id").distinct(), "session_id", "left_semi")))
    plan = C.rank_sessions(counted, C.top_categories(C.category_totals(counted)))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and plan.count("Scan ExistingRDD") == 2
