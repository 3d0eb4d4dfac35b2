"""Column expressions shared by the jobs.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's (bucket edges and names).
# Visit length in seconds: 1-3, 4-6, 7-9, 10-30, 31-60, 61-180, 181-600,
# 601-1800, over 1800.  A 0-second session belongs to no bucket.
VISIT_BUCKETS = [
    ("visit_length_1s_3s", 1, 3),
    ("visit_length_4s_6s", 4, 6),
    ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30),
    ("visit_length_30s_60s", 31, 60),
    ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600),
    ("visit_length_10m_30m", 601, 1800),
    ("visit_length_30m", 1801, None),
]
# Step length (actions per session): 1-3, 4-6, 7-9, 10-30, 31-60, over 60.
STEP_BUCKETS = [
    ("step_length_1_3", 1, 3),
    ("step_length_4_6", 4, 6),
    ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30),
    ("step_length_30_60", 31, 60),
    ("step_length_60", 61, None),
]

# Reference action-time layout: hour not zero-padded (Q10).  The pattern
# below also accepts a padded hour.
ACTION_TIME_PATTERN = "yyyy-MM-dd H:mm:ss"
OUTPUT_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def in_bucket(col: Column, lo: int, hi: int | None) -> Column:
    return (col >= lo) if hi is None else col.between(lo, hi)


def bucket_label(col: Column, buckets) -> Column:
    """Label of the bucket ``col`` falls in, null when none."""
    expr = None
    for name, lo, hi in buckets:
        cond = in_bucket(col, lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def ratio_2dp(n: Column, total: Column) -> Column:
    """``n / total`` rounded half-up to 2 places, exactly.

    Integer arithmetic rounds the true quotient, so the result does not
    depend on how ``n / total`` happens to be represented as a double.
    ``total`` of 0 gives 0.0 (the reference divides by a default of 1).
    """
    t = F.greatest(total, F.lit(1)).cast("bigint")
    return (F.floor((n.cast("bigint") * 200 + t) / (t * 2)).cast("bigint") / F.lit(100.0)).cast(
        "double"
    )


def csv_to_ids(col: Column) -> Column:
    """Comma list of ids -> array<bigint>.

    Empty pieces (trailing comma, empty string) are dropped and a piece
    that is not a number becomes null and is dropped, instead of failing.
    """
    parts = F.filter(F.split(F.coalesce(col, F.lit("")), ","), lambda x: F.trim(x) != "")
    return F.filter(F.transform(parts, lambda x: F.trim(x).try_cast("bigint")), lambda x: x.isNotNull())


def parse_action_time(col: Column) -> Column:
    """action time string -> timestamp; unparseable -> null (Q10)."""
    return F.try_to_timestamp(col, F.lit(ACTION_TIME_PATTERN))


def format_time(col: Column) -> Column:
    """timestamp -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(col, OUTPUT_TIME_PATTERN)


def date_hour_key(col: Column) -> Column:
    """``yyyy-MM-dd_HH``."""
    return F.date_format(col, "yyyy-MM-dd_HH")


def date_key(col: Column) -> Column:
    """``yyyyMMdd``."""
    return F.date_format(col, "yyyyMMdd")


def parse_date_key(col: Column) -> Column:
    """``yyyyMMdd`` -> date."""
    return F.try_to_timestamp(col, F.lit("yyyyMMdd")).cast("date")


def minute_key(col: Column) -> Column:
    """F8: ``yyyyMMddHHmm``."""
    return F.date_format(col, "yyyyMMddHHmm")


def epoch_millis_to_ts(col: Column) -> Column:
    """epoch milliseconds -> timestamp."""
    return F.timestamp_millis(col)


def seconds_between(later: Column, earlier: Column) -> Column:
    """whole seconds from ``earlier`` to ``later`` (truncating)."""
    return ((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000)).cast("bigint")


def zero_pad2(col: Column) -> Column:
    """F14."""
    return F.lpad(col.cast("string"), 2, "0")


def field_from_concat(col: Column, key: str, sep: str = "|") -> Column:
    """value of ``key`` in a ``k=v|k=v`` string (for foreign logs only)."""
    return F.element_at(F.str_to_map(col, F.lit("[" + sep + "]"), F.lit("=")), F.lit(key))


def set_field_in_concat(col: Column, key: str, value: Column, sep: str = "|") -> Column:
    """F16: set ``key`` of a ``k=v|k=v`` string in its place (at the end if it is new)."""

    def own(piece: Column) -> Column:
        return F.substring_index(piece, "=", 1) == key

    new = F.concat(F.lit(key + "="), value.cast("string"))
    pieces = F.filter(F.split(col, "[" + sep + "]"), lambda p: p != "")
    done = F.transform(pieces, lambda p: F.when(own(p), new).otherwise(p))
    return F.array_join(F.when(F.exists(pieces, own), done).otherwise(F.concat(pieces, F.array(new))), sep)


def json_field(col: Column, field: str) -> Column:
    """One field of a JSON object string, as string (null if absent)."""
    return F.get_json_object(col, "$." + field)


def concat_id_name(id_col: Column, name_col: Column, sep: str = "=") -> Column:
    """``id<sep>name``."""
    return F.concat_ws(sep, id_col.cast("string"), name_col)


def distinct_joined(col: Column, sep: str = ",") -> Column:
    """D3: exact distinct values, sorted, joined (aggregate expression)."""
    return F.array_join(F.array_sort(F.collect_set(col)), sep)


def before(a: Column, b: Column) -> Column:
    """``a`` earlier than ``b``."""
    return a < b


def after(a: Column, b: Column) -> Column:
    """``a`` later than ``b``."""
    return a > b


def today() -> Column:
    """current date as ``yyyy-MM-dd`` (for default parameters)."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def yesterday() -> Column:
    """previous day as ``yyyy-MM-dd``."""
    return F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")


def trim_comma(col: Column) -> Column:
    """strip leading/trailing commas."""
    return F.regexp_replace(col, r"^,+|,+$", "")


def is_blank(col: Column) -> Column:
    """F12."""
    return col.isNull() | (col == F.lit(""))
