"""Metamorphic checks: input order and partitioning do not matter."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoplens.operators import funnel as FN
from shoplens.params import TaskParams
from shoplens.plans import session_job
from shoplens.sources.adapters import DriverTables
from tests.conftest import SF_SMALL, sorted_rows

PARAMS = TaskParams(start_date="1970-01-01", end_date="2099-12-31", start_age=20, end_age=50)


def _outputs(actions, users):
    res = session_job.build(actions, users, PARAMS, sample_total=100, seed="m")
    out = {
        "stat": sorted_rows(res.aggr_stat),
        "sample": sorted_rows(res.random_extract),
        "top10": sorted_rows(res.top10_category),
        "top_sessions": sorted_rows(res.top10_session),
        "detail": sorted_rows(res.top10_detail),
        "pairs": sorted_rows(FN.page_pair_counts(actions)),
    }
    return out


def test_results_do_not_depend_on_order_or_partitioning(spark):
    t = DriverTables(spark, SF_SMALL)
    users = t.users()
    base = t.actions()
    one = _outputs(base.repartition(1), users)
    many = _outputs(base.repartition(7, F.rand(seed=3)).sortWithinPartitions(F.rand(seed=5)), users)
    assert one == many
    assert one["stat"][0][0] > 0 and len(one["top10"]) == 10


def test_sample_size_equals_sum_of_quotas(spark):
    from shoplens.operators import sampling as SM
    from shoplens.operators import sessions as S

    t = DriverTables(spark, SF_SMALL)
    sessions = S.filter_sessions(S.session_profile(S.session_rollup(t.actions()), t.users()), PARAMS)
    keyed = sessions.withColumn("date", F.date_format("start_ts", "yyyy-MM-dd")).withColumn(
        "hour", F.date_format("start_ts", "HH")
    )
    quota = SM.hour_quotas(keyed, 100).agg(F.sum("hour_quota")).collect()[0][0]
    assert SM.stratified_sample(sessions, 100, "q").count() == quota


def test_bucket_counts_plus_zero_length_sessions_equal_total(spark):
    from shoplens.functions.columns import VISIT_BUCKETS, in_bucket
    from shoplens.operators import sessions as S

    t = DriverTables(spark, SF_SMALL)
    sessions = S.session_rollup(t.actions(), with_lists=False)
    counts = sessions.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("visit_length") == 0).alias("zero"),
        *[F.count_if(in_bucket(F.col("visit_length"), lo, hi)).alias(name) for name, lo, hi in VISIT_BUCKETS],
    ).collect()[0].asDict()
    assert counts["zero"] + sum(counts[name] for name, _, _ in VISIT_BUCKETS) == counts["n"]
