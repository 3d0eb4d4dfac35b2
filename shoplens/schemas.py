"""Input and output schemas (see FIXTURES.md).  Ids and counts are LongType."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from shoplens.functions.columns import STEP_BUCKETS, VISIT_BUCKETS


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


USER_VISIT_ACTION = _s(
    ("date", StringType()),
    ("user_id", LongType()),
    ("session_id", StringType()),
    ("page_id", LongType()),
    ("action_time", StringType()),
    ("search_keyword", StringType()),
    ("click_category_id", LongType()),
    ("click_product_id", LongType()),
    ("order_category_ids", StringType()),
    ("order_product_ids", StringType()),
    ("pay_category_ids", StringType()),
    ("pay_product_ids", StringType()),
    ("city_id", LongType()),
)

USER_INFO = _s(
    ("user_id", LongType()),
    ("username", StringType()),
    ("name", StringType()),
    ("age", IntegerType()),
    ("professional", StringType()),
    ("city", StringType()),
    ("sex", StringType()),
)

PRODUCT_INFO = _s(
    ("product_id", LongType()),
    ("product_name", StringType()),
    ("extend_info", StringType()),
)

CITY_INFO = _s(
    ("city_id", LongType()),
    ("city_name", StringType()),
    ("area", StringType()),
)

# One decoded ad click.
AD_CLICK = _s(
    ("timestamp_ms", LongType()),
    ("province", StringType()),
    ("city", StringType()),
    ("userid", LongType()),
    ("adid", LongType()),
)

SESSION_AGGR_STAT = _s(
    ("session_count", LongType()),
    *[(name + "_ratio", DoubleType()) for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS],
)

SESSION_DETAIL_COLUMNS = [
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
]

AD_BLACKLIST = _s(("userid", LongType()))
AD_USER_CLICK_COUNT = _s(
    ("date", StringType()), ("userid", LongType()), ("adid", LongType()), ("clickCount", LongType())
)
AD_STAT = _s(
    ("date", StringType()),
    ("province", StringType()),
    ("city", StringType()),
    ("adid", LongType()),
    ("clickCount", LongType()),
)
AD_PROVINCE_TOP3 = _s(
    ("date", StringType()), ("province", StringType()), ("adid", LongType()), ("clickCount", LongType())
)
AD_CLICK_TREND = _s(
    ("date", StringType()),
    ("hour", StringType()),
    ("minute", StringType()),
    ("adid", LongType()),
    ("clickCount", LongType()),
)
