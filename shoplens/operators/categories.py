"""Top-10 categories and their top-10 sessions.

The reference builds the category set with a distinct, counts clicks,
orders and pays in three separate jobs, left-joins them, and goes over all
actions again for the sessions of the top categories.  Here one scan
explodes every action into (category, kind) items, and one grouped aggregate
counts all three kinds: the distinct category set *is* the group set, and the
left joins with their null -> 0 fill are the ``count_if`` defaults.  When both
rankings are wanted, the aggregate is by (category, session) and feeds both
(:func:`category_totals`, :func:`rank_sessions`), so the actions are read
once.  Partial aggregation combines map-side, so a hot category costs one row
per task (per session and task) in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.columns import csv_to_ids
from shoplens.sources.tables import present_id
from shoplens.spark import broadcast_rows

CLICK, ORDER, PAY = 1, 2, 3


def _tagged(ids, kind: int):
    return F.transform(ids, lambda c: F.struct(c.alias("category_id"), F.lit(kind).alias("kind")))


def category_counts(actions: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Click/order/pay counts per category: ``categoryid, clickCount, orderCount, payCount``.

    Default: every category seen in a click, order or pay is counted;
    ``-1``/null means "no click".  ``strict_reference=True`` reproduces the
    reference's filter (Q5): order and pay ids enter the category set only
    when the same action also has a click id > 0, and click category 0 is
    not a category.
    """
    click = F.col("click_category_id")
    click_ids = F.when(present_id(click), F.array(click)).otherwise(F.array().cast("array<bigint>"))
    orders = csv_to_ids(F.col("order_category_ids"))
    pays = csv_to_ids(F.col("pay_category_ids"))
    items = F.concat(_tagged(click_ids, CLICK), _tagged(orders, ORDER), _tagged(pays, PAY))
    exploded = actions.select(F.explode(items).alias("it")).select("it.category_id", "it.kind")
    counts = exploded.groupBy("category_id").agg(
        F.count_if(F.col("kind") == CLICK).alias("clickCount"),
        F.count_if(F.col("kind") == ORDER).alias("orderCount"),
        F.count_if(F.col("kind") == PAY).alias("payCount"),
    )
    if strict_reference:
        # Categories that enter the reference's distinct set.
        gate = present_id(click) & (click > 0)
        members = actions.where(gate).select(
            F.explode(F.concat(F.array(click), orders, pays)).alias("category_id")
        ).distinct()
        counts = counts.join(members, "category_id", "left_semi")
    return counts.withColumnRenamed("category_id", "categoryid")


def category_session_counts(actions: DataFrame) -> DataFrame:
    """``category_id, session_id, clicks, orders, pays, member``: one row per category and session.

    ``member``: some of these items enter the reference's own category set.
    """
    click = F.col("click_category_id")
    click_ids = F.when(present_id(click), F.array(click)).otherwise(F.array().cast("array<bigint>"))
    orders = csv_to_ids(F.col("order_category_ids"))
    pays = csv_to_ids(F.col("pay_category_ids"))
    items = F.concat(_tagged(click_ids, CLICK), _tagged(orders, ORDER), _tagged(pays, PAY))
    gated = F.coalesce(present_id(click) & (click > 0), F.lit(False))
    exploded = actions.select("session_id", gated.alias("gated"), F.explode(items).alias("it"))
    return exploded.groupBy(F.col("it.category_id").alias("category_id"), "session_id").agg(
        F.count_if(F.col("it.kind") == CLICK).alias("clicks"),
        F.count_if(F.col("it.kind") == ORDER).alias("orders"),
        F.count_if(F.col("it.kind") == PAY).alias("pays"),
        F.bool_or("gated").alias("member"),
    )


def category_totals(counted: DataFrame, strict_reference: bool = False) -> DataFrame:
    """:func:`category_counts` from :func:`category_session_counts`."""
    counts = counted.groupBy("category_id").agg(
        F.sum("clicks").alias("clickCount"),
        F.sum("orders").alias("orderCount"),
        F.sum("pays").alias("payCount"),
        F.bool_or("member").alias("member"),
    )
    if strict_reference:
        counts = counts.where("member")
    return counts.drop("member").withColumnRenamed("category_id", "categoryid")


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` categories by (clicks, orders, pays) descending.

    Full 64-bit comparison on each level (Q9) and the category id as the
    final tie-break, so the result is deterministic.  ``orderBy().limit()``
    plans as ``TakeOrderedAndProject``: each task keeps its own top ``n``.
    """
    return counts.orderBy(
        F.desc("clickCount"), F.desc("orderCount"), F.desc("payCount"), F.asc("categoryid")
    ).limit(n)


def rank_sessions(counted: DataFrame, top10: DataFrame, n: int = 10) -> DataFrame:
    """Per top category, the ``n`` sessions with most clicks on it.

    ``categoryid, sessionid, clickCount``; ties broken by session id.
    ``counted`` is the aggregate that ``top10`` was ranked from; ``top10`` has
    at most ``n`` rows by construction, so broadcasting it is bounded.  The
    ``row_number() <= n`` filter with a literal bound lets Spark insert a
    partial per-group limit before the window's shuffle.
    """
    cats = broadcast_rows(top10.select(F.col("categoryid").alias("category_id")), n)
    per_session = counted.where("clicks > 0").join(cats, "category_id", "left_semi")
    w = Window.partitionBy("category_id").orderBy(F.desc("clicks"), F.asc("session_id"))
    return (
        per_session.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= n)
        .select(
            F.col("category_id").alias("categoryid"),
            F.col("session_id").alias("sessionid"),
            F.col("clicks").alias("clickCount"),
        )
    )


def top_sessions_per_category(
    actions: DataFrame, top10: DataFrame, n: int = 10, sessions: DataFrame | None = None
) -> DataFrame:
    """:func:`rank_sessions` from the actions themselves (of ``sessions``, if given).

    The clicks are first cut down to the top categories, so only those reach
    the (large) semi join with ``sessions``.
    """
    cats = broadcast_rows(top10.select(F.col("categoryid").alias("category_id")), n)
    clicks = actions.select("session_id", F.col("click_category_id").alias("category_id")).join(cats, "category_id", "left_semi")
    if sessions is not None:
        clicks = clicks.join(sessions.select("session_id"), "session_id", "left_semi")
    return rank_sessions(clicks.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("clicks")), top10, n)


def top_session_actions(actions: DataFrame, top_sessions: DataFrame, dedupe: bool = False, n: int = 10) -> DataFrame:
    """Actions of the top sessions.

    A session in several categories' lists yields its actions once per
    membership, as in the reference (Q8); ``dedupe=True`` yields them once.
    The session list has at most ``n`` x ``n`` rows.
    """
    keys = top_sessions.select(F.col("sessionid").alias("session_id"))
    if dedupe:
        keys = keys.distinct()
    return actions.join(broadcast_rows(keys, n * n), "session_id", "inner")
