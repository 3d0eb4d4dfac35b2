"""Page-flow conversion (W3, A11, A12, W6; Q11) and the partition-border stitching."""

from __future__ import annotations

import random

import pytest

from shoplens.operators import funnel as FN
from shoplens.params import TaskParams
from tests.conftest import make_actions


def _brute_pairs(rows):
    by_session = {}
    for i, r in enumerate(rows):
        by_session.setdefault(r["session_id"], []).append((r["action_time"], i, r["page_id"]))
    counts = {}
    for acts in by_session.values():
        pages = [p for _, _, p in sorted(acts)]
        for a, b in zip(pages, pages[1:]):
            counts[(a, b)] = counts.get((a, b), 0) + 1
    return counts


def _rows(n_sessions, seed, hot=None):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_sessions):
        size = hot if (hot and s == 0) else rnd.randint(1, 12)
        for _ in range(size):
            sec = rnd.randint(0, 3599)
            rows.append(
                {
                    "session_id": f"s{s:03d}",
                    "page_id": rnd.randint(0, 4),
                    "action_time": f"2024-01-01 0:{sec // 60:02d}:{sec % 60:02d}",
                }
            )
    return rows


@pytest.mark.parametrize("width", [1, 60, 300, 7200])
def test_pairs_equal_brute_force_for_any_partitioning(spark, width):
    rows = _rows(40, seed=width)
    got = {
        (r.from_page, r.to_page): r.pair_count
        for r in FN.page_pair_counts(make_actions(spark, rows), bucket_seconds=width).collect()
    }
    assert got == _brute_pairs(rows)


def test_null_pages_start_pairs_but_end_none(spark):
    rows = _flow_rows([1, None, 2]) + _flow_rows([None, 2], session="t")
    for width in (1, 300):
        got = {
            (r.from_page, r.to_page): r.pair_count
            for r in FN.page_pair_counts(make_actions(spark, rows), bucket_seconds=width).collect()
        }
        assert got == {(None, 2): 2}


def test_hot_session_split_across_buckets(spark):
    # one session holds most rows: time buckets cut through it and the
    # border rows must be joined again
    rows = _rows(5, seed=7, hot=400)
    got = {
        (r.from_page, r.to_page): r.pair_count
        for r in FN.page_pair_counts(make_actions(spark, rows), bucket_seconds=60).collect()
    }
    assert got == _brute_pairs(rows)
    assert sum(got.values()) == len(rows) - len({r["session_id"] for r in rows})


def _flow_rows(pages, session="s", start=0):
    return [
        {"session_id": session, "page_id": p, "action_time": f"2024-01-01 0:00:{start + i:02d}"}
        for i, p in enumerate(pages)
    ]


def test_convert_rate_chain_and_missing_pair(spark):
    rows = _flow_rows([1, 2, 3, 3]) + _flow_rows([1, 2, 4], session="t") + _flow_rows([1], session="u")
    p = TaskParams(start_date="2024-01-01", end_date="2024-01-01", target_page_flow=[1, 2, 3, 4])
    got = [tuple(r) for r in FN.page_convert_rate(make_actions(spark, rows), p).orderBy("step").collect()]
    # 3 views of page 1; 1_2 twice; 2_3 once; 3_4 never (count 0, not an error)
    assert got == [
        (1, "1_2", 2, 3, 2 / 3),
        (2, "2_3", 1, 2, 0.5),
        (3, "3_4", 0, 1, 0.0),
    ]


def test_zero_divisor_gives_null(spark):
    rows = _flow_rows([5, 6])
    p = TaskParams(start_date="2024-01-01", end_date="2024-01-01", target_page_flow=[1, 2, 3])
    got = [tuple(r) for r in FN.page_convert_rate(make_actions(spark, rows), p).orderBy("step").collect()]
    assert got == [(1, "1_2", 0, 0, None), (2, "2_3", 0, 0, None)]


def test_packed_string_in_flow_order(spark):
    rows = _flow_rows([1, 2, 3])
    p = TaskParams(start_date="2024-01-01", end_date="2024-01-01", target_page_flow=[1, 2, 3])
    packed = FN.packed_convert_rate(FN.page_convert_rate(make_actions(spark, rows), p)).collect()[0][0]
    assert packed == "1_2=1.0|2_3=1.0"
