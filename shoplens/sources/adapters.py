"""Map the shared test tables onto the commerce data model.

The driver's tables are a TPC-H-like star schema plus an ``events`` log.
Every mapping is a projection (no shuffle), so the derived tables scale
exactly like their sources.  ``k`` is the integer in ``events.props``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.sources.tables import load_table


def _k():
    return F.get_json_object(F.col("props"), "$.k").try_cast("bigint")


def actions_from_events(events: DataFrame, compress: int = 40) -> DataFrame:
    """``events`` -> ``user_visit_action`` (+ ``action_ts`` and ``tie``).

    One session per user and day.  The time of day is compressed 40-fold
    (a day becomes 36 minutes) so that every visit-length bucket fills;
    ``compress=1`` keeps the time, so that sessions start at all hours.  The
    hour is written unpadded, as the reference's generator does.

    ``k``, the day and the compressed second are computed once in an inner
    projection (the optimiser keeps a non-trivial expression that is used
    several times in its own projection); ``action_ts`` is plain arithmetic
    on them, equal to parsing ``action_time``.
    """
    base = events.select(
        F.col("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("event_type"),
        _k().alias("k"),
        F.to_date(F.col("ts")).alias("day"),
        F.floor((F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")) / compress).cast("int").alias("sec"),
    ).select("*", F.date_format(F.col("day"), "yyyy-MM-dd").alias("date"))
    k, et, eid, sec = F.col("k"), F.col("event_type"), F.col("event_id"), F.col("sec")
    action_time = F.format_string(
        "%s %d:%02d:%02d", F.col("date"), (sec / 3600).cast("int"), ((sec % 3600) / 60).cast("int"), sec % 60
    )
    return base.select(
        "date",
        "user_id",
        F.concat_ws("_", F.col("user_id").cast("string"), F.col("date")).alias("session_id"),
        (k % 10).alias("page_id"),
        action_time.alias("action_time"),
        F.when(et == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(et == "click", k).otherwise(F.lit(-1).cast("bigint")).alias("click_category_id"),
        F.when(et == "click", eid % 100).otherwise(F.lit(-1).cast("bigint")).alias("click_product_id"),
        F.when(et == "purchase", F.concat_ws(",", k.cast("string"), ((k + 7) % 100).cast("string"))).alias(
            "order_category_ids"
        ),
        F.when(et == "purchase", F.concat_ws(",", (eid % 100).cast("string"), ((eid + 7) % 100).cast("string"))).alias(
            "order_product_ids"
        ),
        F.when(et == "signup", k.cast("string")).alias("pay_category_ids"),
        F.when(et == "signup", (eid % 100).cast("string")).alias("pay_product_ids"),
        (F.col("user_id") % 10).cast("bigint").alias("city_id"),
        eid.alias("tie"),
        F.timestamp_seconds(F.unix_date(F.col("day")).cast("bigint") * 86400 + sec).alias("action_ts"),
    )


def users_from_customer(customer: DataFrame) -> DataFrame:
    """``customer`` -> ``user_info``."""
    key = F.col("c_custkey")
    return customer.select(
        key.cast("bigint").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        # 37 is coprime to 60: ages spread over 0-59 for any id range
        ((key * 37) % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(key % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    )


def products_from_part(part: DataFrame) -> DataFrame:
    """``part`` -> ``product_info`` with ``extend_info`` = {"product_status": 0|1}."""
    return part.select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.format_string('{"product_status": %d}', (F.col("p_size") % 2).cast("int")).alias("extend_info"),
    )


def ad_log_from_events(events: DataFrame) -> DataFrame:
    """Click events -> ad log lines ``timestamp_ms province city userid adid``.

    Province and city are ``user_id % 10``; the ad is ``k % 20``.
    """
    ms = (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint")
    region = (F.col("user_id") % 10).cast("string")
    return events.where(F.col("event_type") == "click").select(
        F.concat_ws(" ", ms.cast("string"), region, region, F.col("user_id").cast("string"), (_k() % 20).cast("string")).alias(
            "value"
        )
    )


def cities_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Nation as city, region as area."""
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def clicks_from_lineitem(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Each line item is a click on its part from the buyer's nation.

    Orders are joined to customers first (the smaller join), and only then
    to line items, so the widest table is shuffled once.
    """
    buyer = orders.select("o_orderkey", "o_custkey").join(
        customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    return lineitem.select("l_orderkey", "l_partkey", "l_shipdate").join(
        buyer, F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("c_nationkey").cast("bigint").alias("city_id"),
        F.col("l_partkey").cast("bigint").alias("click_product_id"),
    )


def ts_in_dates(ts_col: str, start_date: str, end_date: str):
    """``ts`` inside the inclusive date range, on the raw column.

    Same rows as filtering the derived ``date`` string, but the predicate is
    on a scan column, so the parquet reader skips row groups outside it.
    """
    lo = F.lit(start_date).cast("date").cast("timestamp_ntz")
    hi = F.date_add(F.lit(end_date).cast("date"), 1).cast("timestamp_ntz")
    return (F.col(ts_col) >= lo) & (F.col(ts_col) < hi)


class DriverTables:
    """Lazy access to the adapted tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def raw(self, name: str) -> DataFrame:
        return load_table(self.spark, self.root, name)

    def actions(self, params=None) -> DataFrame:
        """Adapted actions; with ``params`` the date range is also pushed to the scan."""
        events = self.raw("events")
        if params is not None:
            events = events.where(ts_in_dates("ts", params.start_date, params.end_date))
        return actions_from_events(events)

    def text_actions(self, params) -> DataFrame:
        """Actions at their own time of day, with the time only as the model's text."""
        events = self.raw("events").where(ts_in_dates("ts", params.start_date, params.end_date))
        return actions_from_events(events, compress=1).drop("action_ts")

    def users(self) -> DataFrame:
        return users_from_customer(self.raw("customer"))

    def products(self) -> DataFrame:
        return products_from_part(self.raw("part"))

    def ad_log(self) -> DataFrame:
        return ad_log_from_events(self.raw("events"))

    def cities(self) -> DataFrame:
        return cities_from_nation(self.raw("nation"), self.raw("region"))

    def lineitem_clicks(self, params=None) -> DataFrame:
        """Line-item clicks; with ``params`` the ship-date range is pushed to the scan."""
        lineitem = self.raw("lineitem")
        if params is not None:
            lineitem = lineitem.where(ts_in_dates("l_shipdate", params.start_date, params.end_date))
        return clicks_from_lineitem(lineitem, self.raw("orders"), self.raw("customer"))
