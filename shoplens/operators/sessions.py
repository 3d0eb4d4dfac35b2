"""Session roll-up, profile join, task filter and length statistics.

SURVEY A1, J1, P1, P11, A2, A3, P15, J2, P14.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.columns import (
    STEP_BUCKETS,
    VISIT_BUCKETS,
    format_time,
    in_bucket,
    ratio_2dp,
    seconds_between,
)
from shoplens.params import TaskParams
from shoplens.sources.tables import present_id, user_dimension


#: Seconds of a session that are sorted together.
LIST_BUCKET = 600


def _with_length(rolled: DataFrame) -> DataFrame:
    return rolled.withColumn("visit_length", seconds_between(F.col("end_ts"), F.col("start_ts"))).withColumn(
        "start_time", format_time(F.col("start_ts"))
    )


def _listed(actions: DataFrame) -> DataFrame:
    """Sessions with their lists, repeats included, put together from time buckets."""
    kw, cat = F.col("search_keyword"), F.col("click_category_id")

    def collected(present, value):
        return F.array_sort(F.collect_list(F.when(present, F.struct("action_ts", "tie", value.alias("v")))))

    pieces = actions.groupBy("session_id", F.floor(F.unix_seconds("action_ts") / LIST_BUCKET).alias("bucket")).agg(
        F.min("user_id").alias("user_id"),
        F.min("action_ts").alias("t_min"),
        F.max("action_ts").alias("t_max"),
        F.count(F.lit(1)).alias("steps"),
        collected(kw.isNotNull() & (kw != ""), kw).alias("kws"),
        collected(present_id(cat), cat).alias("cats"),
    )

    def joined(field: str):
        in_order = F.array_sort(F.collect_list(F.struct("bucket", F.transform(field, lambda e: e["v"]).alias("vs"))))
        return F.flatten(F.transform(in_order, lambda p: p["vs"]))

    return pieces.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("t_min").alias("start_ts"),
        F.max("t_max").alias("end_ts"),
        F.sum("steps").alias("step_length"),
        joined("kws").alias("search_keywords"),
        joined("cats").alias("click_category_ids"),
    )


def session_rollup(
    actions: DataFrame,
    with_lists: bool = True,
    keywords: list[str] | None = None,
    category_ids: list[int] | None = None,
    distinct_lists: bool = False,
) -> DataFrame:
    """A1: one row per session.

    Columns: ``session_id, user_id, start_ts, end_ts, start_time,
    visit_length, step_length, search_keywords, click_category_ids``.
    The two lists hold each distinct keyword / click category once, in the
    order the session first used it.

    Two aggregation levels instead of one ``collect_list`` per session:
    level 1 groups by (session, item) and is fully combinable map-side, so
    a session holding a large share of all actions is reduced to one row per
    distinct item before any shuffle; level 2 then handles at most
    "vocabulary size" rows per session.

    ``with_lists=False`` is one combinable aggregation by session (one
    shuffle less) and carries no arrays.  The any-match filters then come
    from ``keywords`` / ``category_ids``: boolean aggregates
    ``keyword_match`` / ``category_match`` (did any action of the session
    search one of the keywords / click one of the categories), which is what
    the filter asks of the lists.
    """
    if not with_lists:
        flags = []
        if keywords:
            flags.append(F.bool_or(F.coalesce(F.col("search_keyword").isin(list(keywords)), F.lit(False)))
                         .alias("keyword_match"))
        if category_ids:
            ids = [int(c) for c in category_ids]
            flags.append(F.bool_or(F.coalesce(F.col("click_category_id").isin(ids), F.lit(False)))
                         .alias("category_match"))
        return _with_length(
            actions.groupBy("session_id").agg(
                F.min("user_id").alias("user_id"),
                F.min("action_ts").alias("start_ts"),
                F.max("action_ts").alias("end_ts"),
                F.count(F.lit(1)).alias("step_length"),
                *flags,
            )
        )
    if not distinct_lists:
        return _with_length(_listed(actions))
    kw = F.col("search_keyword")
    cat = F.col("click_category_id")
    kw_item = F.when(kw.isNotNull() & (kw != ""), F.struct(kw.alias("kw"), F.lit(None).cast("bigint").alias("cat")))
    cat_item = F.when(present_id(cat), F.struct(F.lit(None).cast("string").alias("kw"), cat.alias("cat")))
    items = F.filter(F.array(kw_item, cat_item), lambda x: x.isNotNull())

    per_item = (
        actions.select(
            "session_id",
            "user_id",
            "action_ts",
            "tie",
            F.posexplode_outer(items).alias("pos", "item"),
        )
        .groupBy("session_id", "item")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("action_ts").alias("t_min"),
            F.max("action_ts").alias("t_max"),
            # an action carrying both a keyword and a category is one step
            F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("steps"),
            F.min(F.struct("action_ts", "tie")).alias("first_seen"),
        )
    )

    def ordered(field: str):
        entries = F.collect_list(
            F.when(F.col("item." + field).isNotNull(), F.struct(F.col("first_seen"), F.col("item." + field).alias("v")))
        )
        return F.transform(F.array_sort(entries), lambda e: e["v"])

    return _with_length(
        per_item.groupBy("session_id").agg(
            F.min("user_id").alias("user_id"),
            F.min("t_min").alias("start_ts"),
            F.max("t_max").alias("end_ts"),
            F.sum("steps").alias("step_length"),
            ordered("kw").alias("search_keywords"),
            ordered("cat").alias("click_category_ids"),
        )
    )


def session_profile(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Attach user attributes; sessions without a user row drop out (Q21).

    Plain inner join: Catalyst/AQE broadcast the user side when its size
    is under the broadcast threshold and shuffle (with skew splitting)
    otherwise.
    """
    return sessions.join(user_dimension(users), "user_id", "inner")


def filter_sessions(profiled: DataFrame, params: TaskParams) -> DataFrame:
    """Keep sessions that pass every task filter that is set.

    Uses the ``keyword_match`` / ``category_match`` flags when the roll-up
    computed them, the lists otherwise.
    """
    flags = "keyword_match" in profiled.columns or "category_match" in profiled.columns
    return profiled.where(params.session_predicate(use_flags=flags))


def session_lists(actions: DataFrame) -> DataFrame:
    """``session_id, search_keywords, click_category_ids`` for the given actions.

    Used for the few sessions whose lists are output (the sample): callers
    pass only those sessions' actions.
    """
    return session_rollup(actions).select("session_id", "search_keywords", "click_category_ids")


def session_aggr_stat(filtered: DataFrame) -> DataFrame:
    """Session count and 15 bucket shares in one global aggregate.

    A 0-second session counts in the total but in no visit bucket (Q20).
    """
    counts = [F.count(F.lit(1)).alias("session_count")]
    for name, lo, hi in VISIT_BUCKETS:
        counts.append(F.count_if(in_bucket(F.col("visit_length"), lo, hi)).alias(name))
    for name, lo, hi in STEP_BUCKETS:
        counts.append(F.count_if(in_bucket(F.col("step_length"), lo, hi)).alias(name))
    agg = filtered.agg(*counts)
    total = F.col("session_count")
    return agg.select(
        total,
        *[ratio_2dp(F.col(name), total).alias(name + "_ratio") for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS],
    )


def actions_of_sessions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """The actions of the given sessions (semi join; no columns added).

    Both sides can be large: a shuffled semi join, which AQE turns into a
    broadcast when the session side is small and splits when skewed.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def detail_rows(actions: DataFrame) -> DataFrame:
    """Action -> ``session_detail`` columns (reference names)."""
    return actions.select(
        F.col("user_id").alias("userid"),
        F.col("session_id").alias("sessionid"),
        F.col("page_id").alias("pageid"),
        F.col("action_time").alias("actionTime"),
        F.col("search_keyword").alias("searchKeyword"),
        F.col("click_category_id").alias("clickCategoryId"),
        F.col("click_product_id").alias("clickProductId"),
        F.col("order_category_ids").alias("orderCategoryIds"),
        F.col("order_product_ids").alias("orderProductIds"),
        F.col("pay_category_ids").alias("payCategoryIds"),
        F.col("pay_product_ids").alias("payProductIds"),
    )


def session_output(sessions: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Flatten a rolled-up session for output: lists joined with ','."""
    return sessions.select(
        *extra,
        "session_id",
        "user_id",
        "start_time",
        format_time(F.col("end_ts")).alias("end_time"),
        "visit_length",
        "step_length",
        F.array_join("search_keywords", ",").alias("search_keywords"),
        F.array_join(F.transform("click_category_ids", lambda c: c.cast("string")), ",").alias("click_category_ids"),
    )
