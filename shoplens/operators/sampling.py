"""Stratified random sample of sessions per (date, hour).

The reference counts sessions per hour on the driver, draws indexes with
an unseeded ``Random`` and broadcasts them.  Here the quotas are integer
arithmetic on the (date, hour) count table (at most 24 rows per day) and
the draw follows a seeded hash, so the result is reproducible and no
session list ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_COLUMNS = ["sessionid", "startTime", "searchKeywords", "clickCategoryIds"]


def sample_key(session_id, seed: str):
    """Pseudo-random but reproducible order: md5 of session id + seed."""
    return F.md5(F.concat(session_id, F.lit(seed)))


def hour_quotas(sessions: DataFrame, total: int = 100, seed: str = "shoplens") -> DataFrame:
    """``date, hour, hour_count, day_count, day_quota, hour_quota`` per (date, hour).

    The quotas sum to ``min(total, sessions)``:

    * days share evenly, as in the reference: the sample's places go round
      the days, one each, a day leaving the round when all its sessions have
      a place.  With more days than places, the last round serves the days
      of smallest hash;
    * hours share their day's places by their sessions, by largest remainder
      (equal remainders by hash).

    The input of all this is the (date, hour) count table; the places are at
    most ``total`` per day.
    """
    hours = sessions.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("hour_count"))
    places = (
        hours.groupBy("date")
        .agg(F.sum("hour_count").alias("day_count"))
        .select(
            "date", "day_count",
            F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("day_count", F.lit(total)))).alias("turn"),
        )
    )
    by_turn = ["turn", F.md5(F.concat("date", F.lit(seed))), "date"]
    days = (
        places.orderBy(*by_turn).limit(total)
        .groupBy("date", "day_count").agg(F.count(F.lit(1)).alias("day_quota"))
    )
    by_day = Window.partitionBy("date")
    share = F.col("day_quota") * F.col("hour_count")
    by_rest = by_day.orderBy(F.desc("rest"), F.md5(F.concat("date", "hour", F.lit(seed))), "hour")
    return (
        hours.join(days, "date")
        .withColumn("whole", F.expr("(day_quota * hour_count) div day_count"))
        .withColumn("rest", share % F.col("day_count"))
        .withColumn("left_over", F.col("day_quota") - F.sum("whole").over(by_day))
        .withColumn("turn", F.row_number().over(by_rest))
        .withColumn("hour_quota", F.col("whole") + (F.col("turn") <= F.col("left_over")).cast("bigint"))
        .select("date", "hour", "hour_count", "day_count", "day_quota", "hour_quota")
    )


def stratified_sample(sessions: DataFrame, total: int = 100, seed: str = "shoplens") -> DataFrame:
    """Sample of filtered sessions, the ``hour_quota`` smallest hashes per (date, hour).

    Expects ``session_id, start_ts`` plus the list columns.  Sessions are
    counted per (date, hour, hash bucket); the running count over an hour's
    buckets shows which buckets are in the sample whole and which one holds
    the cut.  Only sessions of those few buckets are ranked, each bucket by
    itself, so a crowded hour never meets in one task, whatever ``total`` is.
    """
    keyed = (
        sessions.withColumn("date", F.date_format("start_ts", "yyyy-MM-dd"))
        .withColumn("hour", F.date_format("start_ts", "HH"))
        .withColumn("draw", sample_key(F.col("session_id"), seed))
        .withColumn("bucket", F.substring("draw", 1, 3))
    )
    stratum = ["date", "hour"]
    # at most 4096 rows per (date, hour)
    buckets = keyed.groupBy(*stratum, "bucket").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy(*stratum).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quotas = hour_quotas(keyed, total, seed).select(*stratum, "hour_quota")
    needed = (
        buckets.withColumn("before", F.sum("n").over(running) - F.col("n"))
        .join(quotas, stratum)
        .where(F.col("before") < F.col("hour_quota"))
        .select(*stratum, "bucket", (F.col("hour_quota") - F.col("before")).alias("places"))
    )
    in_bucket = Window.partitionBy(*stratum, "bucket").orderBy("draw", "session_id")
    return (
        keyed.join(needed, [*stratum, "bucket"])
        .withColumn("rn", F.row_number().over(in_bucket))
        .where(F.col("rn") <= F.col("places"))
        .drop("rn", "places", "draw", "bucket")
    )


def sample_output(sample: DataFrame) -> DataFrame:
    """``session_random_extract`` columns."""
    return sample.select(
        F.col("session_id").alias("sessionid"),
        F.col("start_time").alias("startTime"),
        F.array_join("search_keywords", ",").alias("searchKeywords"),
        F.array_join(F.transform("click_category_ids", lambda c: c.cast("string")), ",").alias("clickCategoryIds"),
    )
