"""Ad-click analytics as DataFrame -> DataFrame functions.

The same functions serve the batch jobs and the ``foreachBatch`` handlers
of the streaming queries, so "stream = batch" holds by construction.
All dates are ``yyyy-MM-dd`` strings at the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

AD_FIELDS = ["timestamp_ms", "province", "city", "userid", "adid"]


def decode_ad_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``timestamp_ms province city userid adid`` -> typed columns + ``ok``.

    Bad numbers or a wrong field count give ``ok = false`` instead of an
    error; :func:`split_valid` separates them.  Adds ``ts`` (timestamp),
    ``date`` (yyyy-MM-dd).
    """
    parts = F.split(F.trim(F.col(value_col)), " +")
    ms = F.get(parts, 0).try_cast("bigint")
    user = F.get(parts, 3).try_cast("bigint")
    ad = F.get(parts, 4).try_cast("bigint")
    out = lines.select(
        F.col(value_col).alias("raw"),
        ms.alias("timestamp_ms"),
        F.get(parts, 1).alias("province"),
        F.get(parts, 2).alias("city"),
        user.alias("userid"),
        ad.alias("adid"),
        (F.size(parts) == 5).alias("_n_ok"),
    )
    ok = (
        F.col("_n_ok")
        & F.col("timestamp_ms").isNotNull()
        & F.col("userid").isNotNull()
        & F.col("adid").isNotNull()
    )
    ts = F.timestamp_millis(F.col("timestamp_ms"))
    return (
        out.withColumn("ok", F.coalesce(ok, F.lit(False)))
        .drop("_n_ok")
        .withColumn("ts", ts)
        .withColumn("date", F.date_format(ts, "yyyy-MM-dd"))
    )


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid clicks, rejected raw lines)."""
    good = decoded.where(F.col("ok")).drop("ok", "raw")
    bad = decoded.where(~F.col("ok")).select("raw")
    return good, bad


def user_ad_counts(clicks: DataFrame) -> DataFrame:
    """``date, userid, adid, clickCount``."""
    return clicks.groupBy("date", "userid", "adid").agg(F.count(F.lit(1)).alias("clickCount"))


def blacklist_users(counts: DataFrame, threshold: int = 100) -> DataFrame:
    """P9 + A16: users with more than ``threshold`` clicks on one ad in one day."""
    return counts.where(F.col("clickCount") > threshold).select("userid").distinct()


def exclude_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Drop clicks of blacklisted users (a real anti join, Q14).

    The blacklist grows with the number of offenders, not with the data;
    the planner broadcasts it while it is under the broadcast threshold.
    """
    return clicks.join(blacklist.select("userid"), "userid", "left_anti")


def ad_stat(clicks: DataFrame) -> DataFrame:
    """``date, province, city, adid, clickCount``."""
    return clicks.groupBy("date", "province", "city", "adid").agg(F.count(F.lit(1)).alias("clickCount"))


def province_top3(stats: DataFrame, n: int = 3) -> DataFrame:
    """A15 + W2: top ``n`` ads per (date, province) (Q13: date is part of the group)."""
    by_province = stats.groupBy("date", "province", "adid").agg(F.sum("clickCount").cast("bigint").alias("clickCount"))
    w = Window.partitionBy("date", "province").orderBy(F.desc("clickCount"), F.asc("adid"))
    return (
        by_province.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= n)
        .select("date", "province", "adid", "clickCount")
    )


def minute_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (minute, ad): ``minute_ts, adid, clickCount``."""
    return clicks.groupBy(F.date_trunc("minute", F.col("ts")).alias("minute_ts"), "adid").agg(
        F.count(F.lit(1)).alias("clickCount")
    )


def trend_rows(per_minute: DataFrame) -> DataFrame:
    """F8: ``date, hour, minute, adid, clickCount`` from per-minute counts."""
    m = F.col("minute_ts")
    return per_minute.select(
        F.date_format(m, "yyyy-MM-dd").alias("date"),
        F.date_format(m, "HH").alias("hour"),
        F.date_format(m, "mm").alias("minute"),
        "adid",
        "clickCount",
    )


def click_trend(clicks: DataFrame) -> DataFrame:
    """R7 (final form): clicks per minute and ad (Q12: event time)."""
    return trend_rows(minute_counts(clicks))


def trailing_hour(per_minute: DataFrame, minutes: int = 60) -> DataFrame:
    """Per ad and minute, clicks in the trailing ``minutes`` (inclusive; a day at most).

    A range frame over the per-minute counts of one ad and day, which are
    ``minutes`` rows of the day before and 1,440 at most, however long the
    history and however many clicks there were: the last minutes of a day
    are carried over into the next day's group and leave it with the frame.
    """
    minute = F.col("minute_ts")
    day, next_day = F.to_date(minute), F.date_add(F.to_date(minute), 1)
    reaches = F.to_date(minute + F.make_dt_interval(mins=F.lit(minutes - 1))) > day
    days = F.when(reaches, F.array(day, next_day)).otherwise(F.array(day))
    rows = per_minute.select("minute_ts", "adid", "clickCount", F.explode(days).alias("day"))
    w = Window.partitionBy("adid", "day").orderBy(F.unix_seconds(minute)).rangeBetween(-(minutes - 1) * 60, 0)
    counted = rows.withColumn("windowCount", F.sum("clickCount").over(w).cast("bigint"))
    return counted.where(F.col("day") == day).select(
        F.date_format("minute_ts", "yyyy-MM-dd HH:mm").alias("minute"), "adid", "windowCount"
    )
