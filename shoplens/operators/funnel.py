"""Page-flow conversion.

Consecutive page pairs need the actions of a session in time order.  A
``lead()`` window by session alone would put a whole session into one task,
and one session may hold a large share of all actions.  So the window runs
by session and time bucket, and a second one over the first and last action
of each bucket joins the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.params import TaskParams

# Width of the time buckets a session is cut into.
BUCKET_SECONDS = 300


def _steps(actions: DataFrame, bucket_seconds: int) -> DataFrame:
    """Each action with its neighbours inside its (session, time bucket).

    ``next`` and ``prev`` are structs, so that "no neighbour" (null) and "a
    neighbour without a page" differ.  Order: action time (nulls first), tie.
    """
    bucket = F.floor(F.unix_seconds("action_ts") / bucket_seconds).alias("bucket")
    w = Window.partitionBy("session_id", "bucket").orderBy(F.col("action_ts").asc_nulls_first(), "tie")
    page = F.struct("page_id")
    return actions.select("session_id", bucket, "action_ts", "tie", "page_id").select(
        "session_id", "bucket", "page_id", F.lead(page).over(w).alias("next"), F.lag(page).over(w).alias("prev")
    )


def step_counts(actions: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``kind, from_page, to_page, n``: views of each page and pairs of consecutive pages.

    Both branches read the same exchange by (session, bucket), so actions
    are scanned and shuffled once.  An action without a session is viewed
    but has no successor.  The second window sees at most two rows per
    session and bucket.
    """
    steps = _steps(actions, bucket_seconds)
    in_session = F.col("session_id").isNotNull()
    inner = steps.groupBy(
        F.col("page_id").alias("from_page"),
        F.when(in_session, F.col("next.page_id")).alias("to_page"),
    ).agg(F.count(F.lit(1)).alias("n"))
    is_last = F.col("next").isNull()
    border = steps.where(in_session & (is_last | F.col("prev").isNull())).select(
        "session_id", "bucket", "page_id", is_last.alias("is_last")
    )
    w = Window.partitionBy("session_id").orderBy(F.col("bucket").asc_nulls_first(), "is_last")
    across = (
        border.withColumn("to_page", F.lead("page_id").over(w))
        .where(F.col("is_last") & F.col("to_page").isNotNull())
        .groupBy(F.col("page_id").alias("from_page"), "to_page")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kind = F.when(F.col("to_page").isNull(), "end").otherwise("inner")
    return inner.select(kind.alias("kind"), "from_page", "to_page", "n").unionByName(
        across.select(F.lit("across").alias("kind"), "from_page", "to_page", "n")
    )


def page_pair_counts(actions: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``from_page, to_page, pair_count`` over consecutive actions per session.

    A pair needs a target page; an unknown page (null) may start one.
    """
    return _pairs(step_counts(actions, bucket_seconds))


def _pairs(counts: DataFrame) -> DataFrame:
    return (
        counts.where(F.col("kind") != "end")
        .groupBy("from_page", "to_page")
        .agg(F.sum("n").cast("bigint").alias("pair_count"))
    )


def flow_frame(spark: SparkSession, params: TaskParams) -> DataFrame:
    """The target flow as a tiny relation: ``step, from_page, to_page``."""
    rows = params.page_pairs()
    return spark.createDataFrame(rows, "step int, from_page bigint, to_page bigint")


def page_convert_rate(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Conversion per step of the target flow, in flow order.

    ``step, page_split, pair_count, prev_count, convert_rate``.  Step 1 is
    divided by the views of the flow's first page (P7/A12), every later step
    by the previous step's pair count.  A pair never seen counts 0 and a
    zero divisor gives null (Q11).
    """
    spark = actions.sparkSession
    # every action is in one row that is not "across": its page's views and
    # the pairs come from the same counts
    flow = flow_frame(spark, params)
    start_page = params.target_page_flow[0]
    counts = step_counts(actions).select(
        "kind", "from_page", "to_page", "n", F.col("from_page").eqNullSafe(F.lit(start_page)).alias("at_start")
    )
    start = F.col("at_start") & (F.col("kind") != "across")
    hit = F.array(
        F.when(start, F.struct(F.lit(start_page).cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("b"))),
        F.when(
            F.col("kind") != "end", F.struct(F.col("from_page").alias("a"), F.col("to_page").alias("b"))
        ),
    )
    totals = (
        counts.select("n", F.explode(F.filter(hit, lambda h: h.isNotNull())).alias("hit"))
        .groupBy("hit.a", "hit.b")
        .agg(F.sum("n").cast("bigint").alias("pair_count"))
    )
    full = flow.unionByName(
        spark.createDataFrame([(0, start_page, None)], "step int, from_page bigint, to_page bigint")
    )
    w = Window.orderBy("step")  # one row per flow step
    return (
        full.join(
            totals, F.col("from_page").eqNullSafe(F.col("a")) & F.col("to_page").eqNullSafe(F.col("b")), "left"
        )
        .withColumn("pair_count", F.coalesce(F.col("pair_count"), F.lit(0).cast("bigint")))
        .withColumn("prev_count", F.lag("pair_count").over(w))
        .where(F.col("step") > 0)
        .select(
            "step",
            F.concat_ws("_", F.col("from_page").cast("string"), F.col("to_page").cast("string")).alias("page_split"),
            "pair_count",
            "prev_count",
            F.try_divide(F.col("pair_count").cast("double"), F.col("prev_count").cast("double")).alias(
                "convert_rate"
            ),
        )
    )


def packed_convert_rate(rates: DataFrame) -> DataFrame:
    """one row, ``convertRate`` = ``a_b=r|b_c=r|...`` in flow order."""
    entries = F.array_sort(
        F.collect_list(
            F.struct(
                F.col("step"),
                F.concat(F.col("page_split"), F.lit("="), F.coalesce(F.col("convert_rate").cast("string"), F.lit("null"))).alias(
                    "s"
                ),
            )
        )
    )
    return rates.agg(F.array_join(F.transform(entries, lambda e: e["s"]), "|").alias("convertRate"))
