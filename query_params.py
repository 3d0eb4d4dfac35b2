"""Parameters of the registered queries (shared by Spark side and oracle).

The date range covers every table completely: the registered queries run
over whole tables.
"""

from shoplens.params import TaskParams

# The reference's default task: age 20-50, no other filter, flow 1..7.
DEFAULT_PARAMS = TaskParams(
    start_date="1970-01-01",
    end_date="2099-12-31",
    start_age=20,
    end_age=50,
)

# Every filter kind set at once.
FILTER_PARAMS = TaskParams(
    start_date="1970-01-01",
    end_date="2099-12-31",
    start_age=20,
    end_age=50,
    professionals=["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"],
    cities=[f"city{i}" for i in range(0, 25, 2)] + ["city1", "city3"],
    sex="female",
    keywords=["kw1", "kw3", "kw5", "kw7"],
    category_ids=list(range(0, 60)),
)

SAMPLE_TOTAL = 100
SAMPLE_SEED = "shoplens"

# Per (date, user, ad) clicks above this make the user an offender.  The
# adapted test data reaches only a few clicks per key, so the registered
# query uses 1 instead of the reference's 100 (a parameter, not a cap).
AD_THRESHOLD = 1

# Area -> level mapping for regions of the test data (the reference's own
# mapping for its Chinese area names is the default in the operator).
LEVEL_OF_AREA = {"A": ["AMERICA", "EUROPE"], "B": ["ASIA"], "C": ["MIDDLE EAST"]}

# Time of day (unpadded hour) and page bands of the row on scalar functions.
CUT_TIME = "0:18:00"
PAGE_BANDS = [("low", 0, 3), ("mid", 4, 6), ("high", 7, None)]

# Rounds of the streaming rows: slices of ten days and some hours, minutes and
# seconds from the first day on; users with this last digit come in the last
# round.  The state of the small test data needs few partitions.
STREAM_ROUNDS = 3
STREAM_START_MS = 1_704_067_200_000
STREAM_SLICE_MS = 876_345_678
STREAM_LATE_DIGIT = 7
STREAM_STATE_PARTITIONS = 4

# Date range that reads the saved table back, and the task id it is stamped with.
TABLE_PARAMS = TaskParams(start_date="2024-01-05", end_date="2024-01-20")
TABLE_TASK = "task-table"
