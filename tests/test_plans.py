"""Plan shape: the properties the scale design relies on stay in the physical plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(spark, name: str) -> str:
    df = E.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["top10_session", "area_top3_product", "ad_province_top3"]
)
def test_per_group_top_k_is_limited_before_the_shuffle(spark, name):
    plan = _plan(spark, name)
    assert "WindowGroupLimit" in plan and "Partial" in plan, plan


def test_global_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "top10_category")


def test_page_pairs_stay_in_the_jvm_and_cut_sessions_by_time(spark):
    df = E.queries()["page_convert_rate"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(session_id" in plan and "bucket" in plan
    assert "MapInPandas" not in plan and "rangepartitioning" not in plan
    # scanned and shuffled by (session, bucket) once, for both branches
    assert plan.count("ReusedExchange") >= 1, plan


def test_area_clicks_are_counted_before_the_city_join(spark):
    plan = _plan(spark, "area_product_count").split("== Initial Plan ==")[0]
    assert "keys=[city_id" in plan and "partial_count(1)" in plan


def test_stats_scan_reads_only_needed_columns(spark):
    plan = _plan(spark, "session_aggr_stat")
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "events" in line][0]
    read_schema = scan.split("ReadSchema:")[1]
    assert "props" not in read_schema and "event_type" not in read_schema, read_schema
    # one aggregation level by session when no list is needed
    assert plan.count("hashpartitioning(session_id") == 1, plan


def test_bounded_sides_are_broadcast(spark):
    plan = _plan(spark, "top10_session_detail")
    assert "BroadcastHashJoin" in plan
    plan = _plan(spark, "session_sample_detail")
    assert "BroadcastHashJoin" in plan


def test_adapter_date_range_reaches_the_scan_and_keeps_the_same_rows(spark):
    from shoplens.params import TaskParams
    from shoplens.sources.adapters import DriverTables
    from shoplens.sources.tables import actions_in_range
    from tests.conftest import sorted_rows

    t = DriverTables(spark, SF_SMALL)
    p = TaskParams(start_date="2024-01-05", end_date="2024-01-09")
    pushed = actions_in_range(t.actions(p), p).select("session_id", "tie")
    derived = actions_in_range(t.actions(), p).select("session_id", "tie")
    assert sorted_rows(pushed) == sorted_rows(derived) and pushed.count() > 0
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts," in plan and "GreaterThanOrEqual(ts," in plan
    li = t.lineitem_clicks(p)
    assert li.count() == t.lineitem_clicks().where("date between '2024-01-05' and '2024-01-09'").count()
