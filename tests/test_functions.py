"""Scalar helpers (F1-F21) and the SQL function surface."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from shoplens.functions import columns as C
from shoplens.functions.sql import register_sql_functions


def test_time_helpers(spark):
    df = spark.createDataFrame([("2024-03-05 7:08:09", "2024-03-05 07:08:19")], "a string, b string")
    ta, tb = C.parse_action_time(F.col("a")), C.parse_action_time(F.col("b"))
    r = df.select(
        C.format_time(ta).alias("fmt"),
        C.date_hour_key(ta).alias("dh"),
        C.date_key(ta).alias("dk"),
        C.minute_key(ta).alias("mk"),
        C.seconds_between(tb, ta).alias("secs"),
        C.before(ta, tb).alias("bf"),
        C.after(ta, tb).alias("af"),
        C.parse_date_key(F.lit("20240305")).cast("string").alias("pd"),
        C.parse_action_time(F.lit("bad")).alias("bad"),
    ).collect()[0]
    assert (r.fmt, r.dh, r.dk, r.mk, r.secs, r.bf, r.af, r.pd, r.bad) == (
        "2024-03-05 07:08:09", "2024-03-05_07", "20240305", "202403050708", 10, True, False, "2024-03-05", None
    )


def test_string_helpers(spark):
    df = spark.createDataFrame([(",a,b,", "k1=v1|k2=v2", 7, "")], "s string, kv string, n int, e string")
    r = df.select(
        C.trim_comma(F.col("s")).alias("tc"),
        C.field_from_concat(F.col("kv"), "k2").alias("fv"),
        C.set_field_in_concat(F.col("kv"), "k1", F.lit("x")).alias("sv"),
        C.set_field_in_concat(F.col("kv"), "k3", F.lit(3)).alias("av"),
        C.set_field_in_concat(F.col("e"), "k", F.lit("v")).alias("ev"),
        C.zero_pad2(F.col("n")).alias("zp"),
        C.is_blank(F.col("e")).alias("blank"),
        C.json_field(F.lit('{"product_status": 1}'), "product_status").alias("js"),
        C.concat_id_name(F.lit(3), F.lit("X")).alias("cn"),
        C.bucket_label(F.lit(45), C.VISIT_BUCKETS).alias("bucket"),
    ).collect()[0]
    assert r.tc == "a,b" and r.fv == "v2" and r.zp == "07" and r.blank
    assert (r.sv, r.av, r.ev) == ("k1=x|k2=v2", "k1=v1|k2=v2|k3=3", "k=v")
    assert r.js == "1" and r.cn == "3=X" and r.bucket == "visit_length_30s_60s"


def test_ratio_matches_half_up_on_exact_quotient(spark):
    pairs = [(n, t) for t in range(1, 60) for n in range(0, t + 1)]
    df = spark.createDataFrame(pairs, "n long, t long")
    got = {(r.n, r.t): r.r for r in df.select("n", "t", C.ratio_2dp(F.col("n"), F.col("t")).alias("r")).collect()}
    for (n, t), r in got.items():
        assert r == (200 * n + t) // (2 * t) / 100.0


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql(
        "SELECT concat_cid_cname(11, 'X', '=') AS c, json_field('{\"product_status\": 0}', 'product_status') AS j"
    ).collect()[0]
    assert (r.c, r.j) == ("11=X", "0")


def test_today_and_yesterday(spark):
    """F4, by the session's own clock and time zone."""
    row = spark.range(1).select(C.today().alias("t"), C.yesterday().alias("y"), F.current_date().alias("d")).first()
    assert row.t == row.d.isoformat() and row.y == (row.d - timedelta(days=1)).isoformat()


def test_distinct_concatenation_in_sql(spark):
    spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("h", None)], "k string, x string").createOrReplaceTempView("shoplens_listagg")
    got = spark.sql("SELECT k, listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x) AS xs FROM shoplens_listagg GROUP BY k").collect()
    assert {r.k: r.xs for r in got} == {"g": "a,b", "h": None}
