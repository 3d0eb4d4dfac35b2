"""Ad analytics in batch form (S8, A13-A16, P9, P10, W2, R7; Q12-Q15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.operators import ads as A

DAY1 = 1704067200000  # 2024-01-01 00:00:00 UTC in ms
DAY2 = DAY1 + 86_400_000


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def _clicks(spark, lines):
    good, _ = A.split_valid(A.decode_ad_log(_lines(spark, lines)))
    return good


def test_decode_and_reject(spark):
    decoded = A.decode_ad_log(_lines(spark, [f"{DAY1} 1 2 3 4", "garbage", f"{DAY1} 1 2 x 4", f"{DAY1} 1 2 3"]))
    good, bad = A.split_valid(decoded)
    g = good.collect()
    assert [(r.timestamp_ms, r.province, r.city, r.userid, r.adid, r.date) for r in g] == [
        (DAY1, "1", "2", 3, 4, "2024-01-01")
    ]
    assert bad.count() == 3


def test_blacklist_threshold_is_strict(spark):
    lines = [f"{DAY1} 1 1 7 1"] * 101 + [f"{DAY1} 1 1 8 1"] * 100
    counts = A.user_ad_counts(_clicks(spark, lines))
    assert [r.userid for r in A.blacklist_users(counts, 100).collect()] == [7]


def test_blacklist_counts_per_ad_and_distinct_users(spark):
    # user 5 exceeds on two ads: listed once (Q15); user 6 spreads clicks over ads
    lines = [f"{DAY1} 1 1 5 1"] * 3 + [f"{DAY1} 1 1 5 2"] * 3 + [f"{DAY1} 1 1 6 {a}" for a in range(6)]
    counts = A.user_ad_counts(_clicks(spark, lines))
    assert [r.userid for r in A.blacklist_users(counts, 2).collect()] == [5]


def test_exclusion_is_a_real_anti_join(spark):
    clicks = _clicks(spark, [f"{DAY1} 1 1 5 1", f"{DAY1} 1 1 6 1"])
    black = spark.createDataFrame([(5,)], "userid bigint")
    assert [r.userid for r in A.exclude_blacklisted(clicks, black).collect()] == [6]


def test_province_top3_groups_by_date(spark):
    lines = []
    for ad, n in [(1, 5), (2, 4), (3, 3), (4, 2)]:
        lines += [f"{DAY1} p c1 9 {ad}"] * n
    lines += [f"{DAY2} p c2 9 7"]
    top = A.province_top3(A.ad_stat(_clicks(spark, lines)))
    got = sorted((r.date, r.adid, r.clickCount) for r in top.collect())
    # day 2's single ad is not starved by day 1's bigger counts (Q13)
    assert got == [("2024-01-01", 1, 5), ("2024-01-01", 2, 4), ("2024-01-01", 3, 3), ("2024-01-02", 7, 1)]


def test_province_rollup_over_cities(spark):
    lines = [f"{DAY1} p c1 9 1"] * 2 + [f"{DAY1} p c2 9 1"] * 2 + [f"{DAY1} p c1 9 2"] * 3
    top = A.province_top3(A.ad_stat(_clicks(spark, lines)))
    assert sorted((r.adid, r.clickCount) for r in top.collect()) == [(1, 4), (2, 3)]


def test_trend_and_trailing_hour(spark):
    m = 60_000
    lines = [f"{DAY1 + 0 * m} 1 1 1 1", f"{DAY1 + 0 * m + 5} 1 1 1 1", f"{DAY1 + 30 * m} 1 1 1 1",
             f"{DAY1 + 60 * m} 1 1 1 1", f"{DAY1 + 61 * m} 1 1 1 2"]
    clicks = _clicks(spark, lines)
    trend = sorted(tuple(r) for r in A.click_trend(clicks).collect())
    assert trend == [
        ("2024-01-01", "00", "00", 1, 2),
        ("2024-01-01", "00", "30", 1, 1),
        ("2024-01-01", "01", "00", 1, 1),
        ("2024-01-01", "01", "01", 2, 1),
    ]
    trail = {(r.minute, r.adid): r.windowCount for r in A.trailing_hour(A.minute_counts(clicks)).collect()}
    # minute 01:00 looks back to 00:01 inclusive: 00:00 has left the hour
    assert trail[("2024-01-01 01:00", 1)] == 2
    assert trail[("2024-01-01 00:30", 1)] == 3
    assert trail[("2024-01-01 01:01", 2)] == 1


def test_dates_are_utc_days(spark):
    clicks = _clicks(spark, [f"{DAY2 - 1} 1 1 1 1"])
    assert clicks.select(F.col("date")).collect()[0][0] == "2024-01-01"


def test_trailing_hour_crosses_midnight(spark):
    """The last minutes of a day reach into the next one; groups hold one day of one ad."""
    minutes = ["2024-01-01 22:59", "2024-01-01 23:00", "2024-01-01 23:01", "2024-01-01 23:59", "2024-01-02 00:00", "2024-01-02 00:59", "2024-01-03 00:10"]
    rows = spark.createDataFrame([(m, 1, 1) for m in minutes] + [("2024-01-02 00:00", 2, 5)], "m string, adid long, clickCount long")
    got = A.trailing_hour(rows.selectExpr("to_timestamp(m) AS minute_ts", "adid", "clickCount"))
    want = {(m, 1): sum(0 <= _minutes(m) - _minutes(x) <= 59 for x in minutes) for m in minutes} | {("2024-01-02 00:00", 2): 5}
    assert {(r.minute, r.adid): r.windowCount for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(adid" in plan and "day" in plan.split("windowspecdefinition(adid")[1][:40]


def _minutes(text):
    from datetime import datetime

    return int((datetime.strptime(text, "%Y-%m-%d %H:%M") - datetime(2024, 1, 1)).total_seconds() // 60)
