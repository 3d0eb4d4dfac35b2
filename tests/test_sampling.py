"""Stratified sample (A9, W5; Q6, Q7)."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from shoplens.operators import sampling as SM
from shoplens.operators import sessions as S
from tests.conftest import make_actions


def _sessions(spark, spec):
    """spec: list of (date, hour, n_sessions)."""
    rows = []
    for d, h, n in spec:
        for i in range(n):
            rows.append({"session_id": f"{d}-{h}-{i}", "date": d, "action_time": f"{d} {h}:10:00"})
    return S.session_rollup(make_actions(spark, rows))


def _quotas(sess, total):
    keyed = sess.withColumn("date", F.date_format("start_ts", "yyyy-MM-dd")).withColumn(
        "hour", F.date_format("start_ts", "HH")
    )
    return {(r.date, r.hour): r.hour_quota for r in SM.hour_quotas(keyed, total).collect()}


def test_quota_follows_hour_share(spark):
    sess = _sessions(spark, [("2024-01-01", 1, 30), ("2024-01-01", 2, 10), ("2024-01-02", 5, 8)])
    # 48 sessions: all fit
    assert _quotas(sess, 100) == {("2024-01-01", "01"): 30, ("2024-01-01", "02"): 10, ("2024-01-02", "05"): 8}
    sample = SM.stratified_sample(sess, 100, "seed").collect()
    assert len(sample) == len({r.session_id for r in sample}) == 48
    # 20 per day; day 2 holds 8, so day 1 gets the other 32: 24 and 8 by its hours
    assert _quotas(sess, 40) == {("2024-01-01", "01"): 24, ("2024-01-01", "02"): 8, ("2024-01-02", "05"): 8}


@pytest.mark.parametrize("days, hours, each", [(7, 24, 2), (30, 24, 1), (101, 1, 2), (150, 2, 1)])
def test_sample_fills_its_total_for_many_days_and_hours(spark, days, hours, each):
    sess = (
        spark.range(days * hours * each)
        .withColumn("start_ts", F.timestamp_seconds(F.lit(1704067200) + F.col("id") % (days * hours) * (86400 // hours)))
        .select(F.col("id").cast("string").alias("session_id"), "start_ts")
    )
    assert SM.stratified_sample(sess, 100, "s").count() == 100
    per_day = SM.stratified_sample(sess, 100, "s").groupBy("date").count().collect()
    assert len(per_day) == min(days, 100)
    assert max(r["count"] for r in per_day) - min(r["count"] for r in per_day) <= 1


def test_total_above_the_window_limit(spark):
    sess = spark.range(9000).select(F.col("id").cast("string").alias("session_id"), F.timestamp_seconds("id").alias("start_ts"))
    got = {r.session_id for r in SM.stratified_sample(sess.where("id < 3600"), 2500, "s").collect()}
    keys = sorted((hashlib.md5((str(i) + "s").encode()).hexdigest(), str(i)) for i in range(3600))
    assert got == {k for _, k in keys[:2500]}


def test_sample_is_deterministic_and_seeded(spark):
    sess = _sessions(spark, [("2024-01-01", 3, 50)])
    a = {r.session_id for r in SM.stratified_sample(sess, 10, "x").collect()}
    b = {r.session_id for r in SM.stratified_sample(sess, 10, "x").collect()}
    c = {r.session_id for r in SM.stratified_sample(sess, 10, "y").collect()}
    assert a == b and len(a) == 10
    assert a != c


def test_quota_larger_than_hour_takes_all(spark):
    # the reference's draw never ends here (Q7); a window sample just takes all
    sess = _sessions(spark, [("2024-01-01", 0, 3)])
    assert SM.stratified_sample(sess, 100, "s").count() == 3


def test_empty_input_empty_sample(spark):
    sess = _sessions(spark, [("2024-01-01", 0, 1)]).where("false")
    assert SM.stratified_sample(sess, 100, "s").count() == 0


def test_sample_output_columns(spark):
    sess = _sessions(spark, [("2024-01-01", 0, 2)])
    out = SM.sample_output(SM.stratified_sample(sess, 100, "s"))
    assert out.columns == SM.SAMPLE_COLUMNS
    assert out.count() == 2
