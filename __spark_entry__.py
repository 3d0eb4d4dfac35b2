"""


Every query reads the whole driver tables of ``sf_dir`` through the
adapter (``shoplens.sources.adapters``); nothing is capped or sampled
except where sampling/top-k is the feature itself.
"""

from __future__ import annotations

import importlib.util
import os
import re
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from query_params import (  # noqa: E402
    AD_THRESHOLD,
    CUT_TIME,
    DEFAULT_PARAMS,
    FILTER_PARAMS,
    LEVEL_OF_AREA,
    PAGE_BANDS,
    SAMPLE_SEED,
    SAMPLE_TOTAL,
    STREAM_LATE_DIGIT,
    STREAM_ROUNDS,
    STREAM_SLICE_MS,
    STREAM_START_MS,
    STREAM_STATE_PARTITIONS,
    TABLE_PARAMS,
    TABLE_TASK,
)
from shoplens.functions import columns as K  # noqa: E402
from shoplens.operators import ads as A  # noqa: E402
from shoplens.operators import categories as C  # noqa: E402
from shoplens.operators import funnel as FN  # noqa: E402
from shoplens.operators import products as P  # noqa: E402
from shoplens.operators import sampling as SM  # noqa: E402
from shoplens.operators import sessions as S  # noqa: E402
from shoplens.params import TaskParams  # noqa: E402
from shoplens.schemas import AD_PROVINCE_TOP3, AD_USER_CLICK_COUNT  # noqa: E402
from shoplens.sinks.folders import overwrite_partitions, read_folder, stored_rows  # noqa: E402
from shoplens.sinks.merge import append_new, merge_add, merge_overwrite, replace_groups  # noqa: E402
from shoplens.sinks.writers import TableSink, with_task_id  # noqa: E402
from shoplens.sources.adapters import DriverTables  # noqa: E402
from shoplens.sources.tables import (  # noqa: E402
    actions_in_range,
    city_dimension,
    click_product_pairs,
    prepare_actions,
)
from shoplens.spark import broadcast_rows, cut_lineage, ensure_checkpoint_dir  # noqa: E402
from shoplens.streaming import ad_stream as ST  # noqa: E402

# the training-data operators are an optional part: where they are absent they are left out, but if they
# are there, an error in importing them is an error
if importlib.util.find_spec("shoplens.llm.queries") if importlib.util.find_spec("shoplens.llm") else None:
    from shoplens.llm import queries as LLM  # noqa: E402
else:
    LLM = None
if LLM and importlib.util.find_spec("corpus_pipeline"):
    import corpus_pipeline  # noqa: E402
else:
    corpus_pipeline = None

SF_SMOKE = "/root/testdata/sf0.001"


def _prep(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def _rolled(spark, sf_dir, p: TaskParams, with_lists: bool = True):
    _prep(spark)
    t = DriverTables(spark, sf_dir)
    return t, S.session_rollup(actions_in_range(t.actions(p), p), with_lists)


def _filtered(spark, sf_dir, p: TaskParams, with_lists: bool = True):
    t, rolled = _rolled(spark, sf_dir, p, with_lists)
    return t, S.filter_sessions(S.session_profile(rolled, t.users()), p)


PROFILE_COLS = ("age", "professional", "city", "sex")


def q_session_rollup(spark, sf_dir):
    _, rolled = _rolled(spark, sf_dir, DEFAULT_PARAMS)
    return S.session_output(rolled)


def q_session_rollup_distinct(spark, sf_dir):
    """A1 as the reference's comment promises it: every keyword and category once."""
    _prep(spark)
    actions = actions_in_range(DriverTables(spark, sf_dir).actions(DEFAULT_PARAMS), DEFAULT_PARAMS)
    return S.session_output(S.session_rollup(actions, distinct_lists=True))


def q_session_user_profile(spark, sf_dir):
    t, rolled = _rolled(spark, sf_dir, DEFAULT_PARAMS)
    return S.session_output(S.session_profile(rolled, t.users()), PROFILE_COLS)


def q_session_task_filter(spark, sf_dir):
    _, filt = _filtered(spark, sf_dir, FILTER_PARAMS)
    return S.session_output(filt, PROFILE_COLS)


def _lean_filtered(spark, sf_dir, p: TaskParams):
    """Filtered sessions without lists: the any-match filters are flags."""
    _prep(spark)
    t = DriverTables(spark, sf_dir)
    rolled = S.session_rollup(
        actions_in_range(t.actions(p), p), with_lists=False, keywords=p.keywords, category_ids=p.category_ids
    )
    return t, S.filter_sessions(S.session_profile(rolled, t.users()), p)


def q_session_aggr_stat(spark, sf_dir):
    return S.session_aggr_stat(_lean_filtered(spark, sf_dir, DEFAULT_PARAMS)[1])


def q_session_aggr_stat_filtered(spark, sf_dir):
    return S.session_aggr_stat(_lean_filtered(spark, sf_dir, FILTER_PARAMS)[1])


def _filtered_actions(spark, sf_dir, p=DEFAULT_PARAMS):
    t, filt = _lean_filtered(spark, sf_dir, p)
    return t, filt, S.actions_of_sessions(actions_in_range(t.actions(p), p), filt)


def _sample(spark, sf_dir):
    t, filt = _lean_filtered(spark, sf_dir, DEFAULT_PARAMS)
    return t, SM.stratified_sample(filt, SAMPLE_TOTAL, SAMPLE_SEED)


def q_session_random_extract(spark, sf_dir):
    # lists only for the sampled sessions, SAMPLE_TOTAL at most
    t, sample = _sample(spark, sf_dir)
    acts = actions_in_range(t.actions(DEFAULT_PARAMS), DEFAULT_PARAMS)
    lists = S.session_lists(acts.join(broadcast_rows(sample.select("session_id"), SAMPLE_TOTAL), "session_id", "left_semi"))
    return SM.sample_output(sample.join(lists, "session_id"))


def q_session_sample_detail(spark, sf_dir):
    t, sample = _sample(spark, sf_dir)
    acts = actions_in_range(t.actions(DEFAULT_PARAMS), DEFAULT_PARAMS)
    return S.detail_rows(acts.join(broadcast_rows(sample.select("session_id"), SAMPLE_TOTAL), "session_id", "left_semi"))


def _day_sample(spark, sf_dir):
    """The sample over sessions of all 24 hours, whose times are the data model's text."""
    _prep(spark)
    t = DriverTables(spark, sf_dir)
    p = DEFAULT_PARAMS
    acts = actions_in_range(prepare_actions(t.text_actions(p)), p)
    filt = S.filter_sessions(S.session_profile(S.session_rollup(acts, with_lists=False), t.users()), p)
    return acts, SM.stratified_sample(filt, SAMPLE_TOTAL, SAMPLE_SEED)


def q_session_random_extract_day(spark, sf_dir):
    acts, sample = _day_sample(spark, sf_dir)
    lists = S.session_lists(acts.join(sample.select("session_id"), "session_id", "left_semi"))
    return SM.sample_output(sample.join(lists, "session_id"))


def q_session_sample_detail_day(spark, sf_dir):
    acts, sample = _day_sample(spark, sf_dir)
    return S.detail_rows(acts.join(sample.select("session_id"), "session_id", "left_semi"))


def q_session_detail_semi(spark, sf_dir):
    return S.detail_rows(_filtered_actions(spark, sf_dir)[2])


def q_category_counts(spark, sf_dir):
    return C.category_counts(_filtered_actions(spark, sf_dir)[2])


def q_category_counts_strict(spark, sf_dir):
    """Q5: only categories that the reference's own filter lets in."""
    return C.category_counts(_filtered_actions(spark, sf_dir)[2], strict_reference=True)


def q_top10_category(spark, sf_dir):
    return C.top_categories(C.category_counts(_filtered_actions(spark, sf_dir)[2]))


def _top_sessions(spark, sf_dir):
    t, filt = _lean_filtered(spark, sf_dir, DEFAULT_PARAMS)
    ranged = actions_in_range(t.actions(DEFAULT_PARAMS), DEFAULT_PARAMS)
    # one semi join of the actions; its aggregate feeds both rankings
    counted = cut_lineage(C.category_session_counts(S.actions_of_sessions(ranged, filt)))
    return ranged, C.rank_sessions(counted, C.top_categories(C.category_totals(counted)))


def q_top10_session(spark, sf_dir):
    return _top_sessions(spark, sf_dir)[1]


def q_top10_session_detail(spark, sf_dir):
    # the top sessions are filtered sessions already: a broadcast of at most
    # 100 session ids into the action scan, no second semi join
    ranged, top = _top_sessions(spark, sf_dir)
    return S.detail_rows(C.top_session_actions(ranged, top))


def q_top10_session_detail_dedupe(spark, sf_dir):
    """Q8: a session on the list of several categories has its actions once."""
    ranged, top = _top_sessions(spark, sf_dir)
    return S.detail_rows(C.top_session_actions(ranged, top, True))


def q_action_keys(spark, sf_dir):
    """F1, F3, F6-F8, F12-F16 and P11 over every action."""
    acts = _page_actions(spark, sf_dir)
    day, cut = K.date_key("action_ts"), K.parse_action_time(F.concat("date", F.lit(" " + CUT_TIME)))
    info = F.concat(
        F.lit("page="), F.col("page_id"), F.lit("|session="), F.col("session_id"), F.lit("|city="), F.col("city_id")
    )
    return acts.select(
        "tie",
        K.date_hour_key("action_ts").alias("date_hour"),
        day.alias("day_key"),
        K.parse_date_key(day).cast("string").alias("day"),
        K.minute_key("action_ts").alias("minute_key"),
        K.before(F.col("action_ts"), cut).alias("is_before"),
        K.after(F.col("action_ts"), cut).alias("is_after"),
        K.is_blank(F.col("search_keyword")).alias("no_keyword"),
        K.trim_comma(F.concat(F.lit(","), F.col("order_category_ids"), F.lit(",,"))).alias("ordered"),
        K.zero_pad2(F.col("page_id")).alias("page2"),
        K.bucket_label(F.col("page_id"), PAGE_BANDS).alias("page_band"),
        K.field_from_concat(info, "city").alias("city"),
        K.set_field_in_concat(info, "page", F.col("page_id") + 1).alias("next_page"),
    )


def _page_actions(spark, sf_dir):
    _prep(spark)
    return actions_in_range(DriverTables(spark, sf_dir).actions(DEFAULT_PARAMS), DEFAULT_PARAMS)


def q_page_pairs(spark, sf_dir):
    return FN.page_pair_counts(_page_actions(spark, sf_dir))


def q_page_convert_rate(spark, sf_dir):
    return FN.page_convert_rate(_page_actions(spark, sf_dir), DEFAULT_PARAMS)


def q_page_convert_rate_packed(spark, sf_dir):
    return FN.packed_convert_rate(q_page_convert_rate(spark, sf_dir))


def _area_counts(spark, sf_dir):
    _prep(spark)
    t = DriverTables(spark, sf_dir)
    clicks = click_product_pairs(t.lineitem_clicks(DEFAULT_PARAMS), DEFAULT_PARAMS)
    return t, P.area_product_counts(clicks, t.cities())


def q_area_product_count(spark, sf_dir):
    return _area_counts(spark, sf_dir)[1]


def q_area_top3_product(spark, sf_dir):
    t, counts = _area_counts(spark, sf_dir)
    return P.area_top3_products(counts, t.products(), levels=LEVEL_OF_AREA)


def q_area_top3_product_inline_cities(spark, sf_dir):
    _prep(spark)
    t = DriverTables(spark, sf_dir)
    clicks = click_product_pairs(t.actions(DEFAULT_PARAMS), DEFAULT_PARAMS)
    counts = P.area_product_counts(clicks, city_dimension(spark), broadcast_cities=True)
    return P.area_top3_products(counts, t.products())


def q_area_top3_product_sql(spark, sf_dir):
    """The product job in Spark SQL over temp views."""
    from shoplens.functions.sql import register_sql_functions
    from shoplens.plans.product_job import build_sql
    from shoplens.sources.views import register_views

    _prep(spark)
    t = DriverTables(spark, sf_dir)
    register_sql_functions(spark)
    register_views(
        {
            "user_visit_action": t.actions(DEFAULT_PARAMS),
            "city_info": city_dimension(spark),
            "product_info": t.products(),
        }
    )
    return build_sql(spark, DEFAULT_PARAMS)


def _ad_clicks(spark, sf_dir):
    _prep(spark)
    good, _ = A.split_valid(A.decode_ad_log(DriverTables(spark, sf_dir).ad_log()))
    return good


def _ad_filtered(spark, sf_dir):
    clicks = _ad_clicks(spark, sf_dir)
    black = A.blacklist_users(A.user_ad_counts(clicks), AD_THRESHOLD)
    return A.exclude_blacklisted(clicks, black)


def q_ad_user_click_count(spark, sf_dir):
    return A.user_ad_counts(_ad_clicks(spark, sf_dir))


def q_ad_blacklist(spark, sf_dir):
    return A.blacklist_users(A.user_ad_counts(_ad_clicks(spark, sf_dir)), AD_THRESHOLD)


def q_ad_blacklist_filtered(spark, sf_dir):
    return _ad_filtered(spark, sf_dir).select("timestamp_ms", "province", "city", "userid", "adid", "date")


def q_ad_stat(spark, sf_dir):
    return A.ad_stat(_ad_filtered(spark, sf_dir))


def q_ad_province_top3(spark, sf_dir):
    return A.province_top3(A.ad_stat(_ad_filtered(spark, sf_dir)))


def q_ad_click_trend(spark, sf_dir):
    return A.click_trend(_ad_clicks(spark, sf_dir))


def q_ad_trailing_hour(spark, sf_dir):
    return A.trailing_hour(A.minute_counts(_ad_clicks(spark, sf_dir)))


def _click_halves(spark, sf_dir):
    """All clicks, split by day of month into a stored part and a new part."""
    clicks = _ad_clicks(spark, sf_dir)
    early = F.dayofmonth("ts") <= 15
    return clicks.where(early), clicks.where(~early)


def q_upsert_merge(spark, sf_dir):
    """K9: stored totals (days 1-15) + additive merge of days 16-31 = totals of all days."""
    stored, new = _click_halves(spark, sf_dir)
    keys = ["date", "province", "city", "adid"]
    return merge_add(A.ad_stat(stored), A.ad_stat(new), keys, "clickCount")


def q_upsert_overwrite(spark, sf_dir):
    """Totals stored at noon (days 1-20), then final totals of days 11-31 over them."""
    clicks = _ad_clicks(spark, sf_dir)
    stored = clicks.where((F.dayofmonth("ts") <= 20) & (F.hour("ts") < 12))
    final = clicks.where(F.dayofmonth("ts") > 10)
    return merge_overwrite(A.ad_stat(stored), A.ad_stat(final), ["date", "province", "city", "adid"])


def q_replace_groups(spark, sf_dir):
    """Top-3 of the stored days, groups touched by new days replaced by their new top-3."""
    stored, new = _click_halves(spark, sf_dir)
    touched = new.select("date", "province").distinct()
    fresh = A.province_top3(A.ad_stat(stored.unionByName(new)).join(touched, ["date", "province"], "left_semi"))
    return replace_groups(A.province_top3(A.ad_stat(stored)), fresh, ["date", "province"])


def q_append_new(spark, sf_dir):
    """Blacklist of the stored days, then offenders of the new days appended once."""
    stored, new = _click_halves(spark, sf_dir)
    old = A.blacklist_users(A.user_ad_counts(stored), AD_THRESHOLD)
    return append_new(old, A.blacklist_users(A.user_ad_counts(new), AD_THRESHOLD), ["userid"])


def _stream_rounds(spark, sf_dir):
    """The ad log that Spark derives from ``events``, as three rounds of lines.

    A live stream arrives in time order: rounds are slices of time that end
    inside days, hours and minutes, so keys go on over rounds.  Clicks of one
    user in ten come in the last round, up to weeks late; untimed lines come
    in the first.
    """
    fields = F.split(F.trim(F.col("value")), " +")
    ms, user = F.get(fields, 0).try_cast("bigint"), F.get(fields, 3).try_cast("bigint")
    number = F.floor((ms - F.lit(STREAM_START_MS)) / F.lit(STREAM_SLICE_MS))
    number = F.greatest(F.lit(0), F.least(F.lit(STREAM_ROUNDS - 1), number))
    number = F.when(user % 10 == STREAM_LATE_DIGIT, STREAM_ROUNDS - 1).otherwise(number)
    lines = DriverTables(spark, sf_dir).ad_log()
    return [lines.where(F.coalesce(number, F.lit(0)) == r) for r in range(STREAM_ROUNDS)]


class _Stream:
    """Folders of one run of the ad stream; queries end and start again from their checkpoints in every round."""

    def __init__(self, spark, sf_dir):
        _prep(spark)
        self.spark, self.rounds = spark, _stream_rounds(spark, sf_dir)
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shoplens-stream-{uuid.uuid4().hex}"
        self.out = self.root + "/out"

    def run(self, log: str, *names: str, **options) -> ST.AdTables:
        return ST.run_available(
            self.spark, f"{self.root}/{log}", self.out, self.root + "/ckpt", AD_THRESHOLD, names=names,
            state_partitions=STREAM_STATE_PARTITIONS, **options,
        )

    def all_rounds(self, log: str, *names: str, **options) -> ST.AdTables:
        for lines in self.rounds:
            ST.write_log(lines, f"{self.root}/{log}")
            tables = self.run(log, *names, **options)
        return tables


def q_stream_ad_stat(spark, sf_dir):
    """Running totals as state, after the list is complete."""
    stream = _Stream(spark, sf_dir)
    stream.all_rounds("listing", "ad_blacklist")
    return stream.all_rounds("counting", "ad_filter", "ad_stat").stat()


def q_stream_ad_stat_refreshed(spark, sf_dir):
    """Every round is filtered by the list as the rounds before have left it."""
    stream = _Stream(spark, sf_dir)
    for lines in stream.rounds:
        ST.write_log(lines, stream.root + "/log")
        stream.run("log", "ad_filter")
        stream.run("log", "ad_blacklist")
    return stream.run("log", "ad_stat").stat()


def q_stream_province_top3(spark, sf_dir):
    """Partitions of (date, province) overwritten in every round."""
    stream = _Stream(spark, sf_dir)
    stream.all_rounds("listing", "ad_blacklist")
    return stream.all_rounds("counting", "ad_filter", "ad_province").province_top3()


def q_stream_user_click_count(spark, sf_dir):
    return _Stream(spark, sf_dir).all_rounds("log", "ad_blacklist").user_click_count()


def q_stream_ad_trend(spark, sf_dir):
    return _Stream(spark, sf_dir).all_rounds("log", "ad_trend").click_trend()


def q_stream_ad_trend_filtered(spark, sf_dir):
    """Q12 with the filter on: the trend of the kept clicks."""
    stream = _Stream(spark, sf_dir)
    stream.all_rounds("listing", "ad_blacklist")
    return stream.all_rounds("counting", "ad_filter", "ad_trend", filter_trend=True).click_trend()


def q_stream_ad_trailing_hour(spark, sf_dir):
    """Windows of an hour, one every minute, as state."""
    return _Stream(spark, sf_dir).all_rounds("log", "ad_trailing_hour").trailing_hour()


def q_stream_blacklist(spark, sf_dir):
    return _Stream(spark, sf_dir).all_rounds("log", "ad_blacklist").blacklist()


def _folder(spark, label: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/shoplens-{label}-{uuid.uuid4().hex}"


def q_replace_groups_written(spark, sf_dir):
    """K12 written and read back: the top-3 of the morning clicks, then the groups that the rest touches anew.

    Two rounds of dynamic overwrites of (date, province) partitions.
    """
    clicks, path, groups = _ad_clicks(spark, sf_dir), _folder(spark, "top3"), ["date", "province"]
    morning = clicks.where(F.hour("ts") < 12)
    overwrite_partitions(A.province_top3(A.ad_stat(morning)), path, groups)
    touched = clicks.where(F.hour("ts") >= 12).select(*groups).distinct()
    overwrite_partitions(A.province_top3(A.ad_stat(clicks.join(touched, groups, "left_semi"))), path, groups)
    return read_folder(spark, path, AD_PROVINCE_TOP3)


def q_stored_count_lookup(spark, sf_dir):
    """The new clicks' counts beside the stored counts of their keys (stored by date)."""
    clicks, path = _ad_clicks(spark, sf_dir), _folder(spark, "stored-counts")
    overwrite_partitions(A.user_ad_counts(clicks.where(F.hour("ts") < 12)), path, ["date"])
    new = A.user_ad_counts(clicks.where(F.hour("ts") >= 12)).withColumnRenamed("clickCount", "newCount")
    keys = ["date", "userid", "adid"]
    stored = stored_rows(read_folder(spark, path, AD_USER_CLICK_COUNT), new, keys, "date")
    stored = stored.withColumnRenamed("clickCount", "storedCount")
    found = new.join(stored, keys, "left")
    count = F.coalesce("storedCount", F.lit(0)).cast("bigint")
    return found.select(*keys, "newCount", count.alias("storedCount"), (F.col("newCount") + count).alias("clickCount"))


def q_table_round_trip(spark, sf_dir):
    """Actions stamped with a task id, saved as a catalog table by date, and scanned by a date range."""
    _prep(spark)
    name = f"shoplens_actions_{re.sub('[^A-Za-z0-9]', '_', spark.sparkContext.applicationId)}"
    sink = TableSink("overwrite", partition_by={name: ["date"]}, location=_folder(spark, "tables"))
    actions = DriverTables(spark, sf_dir).actions(DEFAULT_PARAMS).drop("action_ts")
    sink.write(name, with_task_id(actions, TABLE_TASK))
    ranged = actions_in_range(spark.table(name), TABLE_PARAMS)
    return ranged.select("taskid", "tie", "date", "user_id", "session_id", "page_id", "action_time", "click_category_id")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: ``session_aggr_stat`` over the sf0.001 tables (one row)."""
    return q_session_aggr_stat(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "session_rollup": q_session_rollup,
        "session_rollup_distinct": q_session_rollup_distinct,
        "session_user_profile": q_session_user_profile,
        "session_task_filter": q_session_task_filter,
        "session_aggr_stat": q_session_aggr_stat,
        "session_aggr_stat_filtered": q_session_aggr_stat_filtered,
        "session_random_extract": q_session_random_extract,
        "session_sample_detail": q_session_sample_detail,
        "session_random_extract_day": q_session_random_extract_day,
        "session_sample_detail_day": q_session_sample_detail_day,
        "session_detail_semi": q_session_detail_semi,
        "category_counts": q_category_counts,
        "category_counts_strict": q_category_counts_strict,
        "top10_category": q_top10_category,
        "top10_session": q_top10_session,
        "top10_session_detail": q_top10_session_detail,
        "top10_session_detail_dedupe": q_top10_session_detail_dedupe,
        "action_keys": q_action_keys,
        "page_pairs": q_page_pairs,
        "page_convert_rate": q_page_convert_rate,
        "page_convert_rate_packed": q_page_convert_rate_packed,
        "area_product_count": q_area_product_count,
        "area_top3_product": q_area_top3_product,
        "area_top3_product_inline_cities": q_area_top3_product_inline_cities,
        "area_top3_product_sql": q_area_top3_product_sql,
        "ad_user_click_count": q_ad_user_click_count,
        "ad_blacklist": q_ad_blacklist,
        "ad_blacklist_filtered": q_ad_blacklist_filtered,
        "ad_stat": q_ad_stat,
        "ad_province_top3": q_ad_province_top3,
        "ad_click_trend": q_ad_click_trend,
        "ad_trailing_hour": q_ad_trailing_hour,
        "upsert_merge": q_upsert_merge,
        "upsert_overwrite": q_upsert_overwrite,
        "replace_groups": q_replace_groups,
        "append_new": q_append_new,
        "stream_ad_stat": q_stream_ad_stat,
        "stream_province_top3": q_stream_province_top3,
        "stream_user_click_count": q_stream_user_click_count,
        "stream_ad_trend": q_stream_ad_trend,
        "stream_blacklist": q_stream_blacklist,
        "stream_ad_stat_refreshed": q_stream_ad_stat_refreshed,
        "stream_ad_trend_filtered": q_stream_ad_trend_filtered,
        "stream_ad_trailing_hour": q_stream_ad_trailing_hour,
        "replace_groups_written": q_replace_groups_written,
        "stored_count_lookup": q_stored_count_lookup,
        "table_round_trip": q_table_round_trip,
        **(LLM.queries() if LLM else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


def oracle_sql() -> dict[str, str]:
    from oracle_sql import oracle_queries

    own = oracle_queries()
    if LLM:
        own |= LLM.oracle_sql()
        if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
            own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own
