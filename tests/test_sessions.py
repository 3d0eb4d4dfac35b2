"""Hand-made golden cases for the session job."""

from __future__ import annotations

import pytest

from shoplens.operators import sessions as S
from shoplens.params import TaskParams
from tests.conftest import make_actions, make_users

LENGTHS = [0, 1, 3, 4, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]


def _session_of_length(sid: str, seconds: int, user: int = 1):
    h, rem = divmod(seconds, 3600)
    m, s = divmod(rem, 60)
    return [
        {"session_id": sid, "user_id": user, "action_time": "2024-01-01 0:00:00"},
        {"session_id": sid, "user_id": user, "action_time": f"2024-01-01 {h}:{m:02d}:{s:02d}"},
    ]


def test_visit_length_bucket_edges(spark):
    rows = []
    for n in LENGTHS:
        rows += _session_of_length(f"s{n}", n)
    sessions = S.session_rollup(make_actions(spark, rows))
    got = dict((r.session_id, r.visit_length) for r in sessions.collect())
    assert got == {f"s{n}": n for n in LENGTHS}
    stat = S.session_aggr_stat(sessions).collect()[0].asDict()
    total = len(LENGTHS)
    assert stat["session_count"] == total
    # Q20: 30 s -> 10_30, 31 -> 30_60, 60 -> 30_60; a 0 s session is in no bucket
    expect = {
        "visit_length_1s_3s_ratio": 2,
        "visit_length_4s_6s_ratio": 1,
        "visit_length_7s_9s_ratio": 1,
        "visit_length_10s_30s_ratio": 2,
        "visit_length_30s_60s_ratio": 2,
        "visit_length_1m_3m_ratio": 2,
        "visit_length_3m_10m_ratio": 2,
        "visit_length_10m_30m_ratio": 2,
        "visit_length_30m_ratio": 1,
    }
    for name, n in expect.items():
        assert stat[name] == round(n / total + 1e-12, 2), name
    assert sum(expect.values()) == total - 1


def test_step_length_bucket_edges(spark):
    rows = []
    steps = [1, 3, 4, 9, 10, 30, 31, 60, 61]
    for n in steps:
        rows += [{"session_id": f"s{n}", "action_time": "2024-01-01 0:00:00"}] * n
    sessions = S.session_rollup(make_actions(spark, rows))
    got = dict((r.session_id, r.step_length) for r in sessions.collect())
    assert got == {f"s{n}": n for n in steps}
    stat = S.session_aggr_stat(sessions).collect()[0].asDict()
    assert stat["step_length_1_3_ratio"] == 0.22  # 2 of 9, half-up
    assert stat["step_length_10_30_ratio"] == 0.22
    assert stat["step_length_30_60_ratio"] == 0.22
    assert stat["step_length_60_ratio"] == 0.11


def test_ratio_is_half_up(spark):
    # 1 of 8 = 0.125 -> 0.13 (half-up, not banker's)
    rows = []
    for i in range(8):
        rows += _session_of_length(f"s{i}", 2 if i == 0 else 0)
    stat = S.session_aggr_stat(S.session_rollup(make_actions(spark, rows))).collect()[0]
    assert stat.visit_length_1s_3s_ratio == 0.13


def test_empty_input_gives_zero_count(spark):
    acts = make_actions(spark, [{"session_id": "x"}]).where("false")
    stat = S.session_aggr_stat(S.session_rollup(acts)).collect()[0]
    assert stat.session_count == 0
    assert stat.visit_length_1s_3s_ratio == 0.0


def test_lists_are_distinct_in_first_seen_order(spark):
    rows = [
        {"action_time": "2024-01-01 0:00:05", "search_keyword": "b"},
        {"action_time": "2024-01-01 0:00:01", "search_keyword": "a"},
        {"action_time": "2024-01-01 0:00:09", "search_keyword": "a"},
        {"action_time": "2024-01-01 0:00:02", "click_category_id": 7},
        {"action_time": "2024-01-01 0:00:03", "click_category_id": 0},
        {"action_time": "2024-01-01 0:00:04", "click_category_id": 7},
        {"action_time": "2024-01-01 0:00:06", "search_keyword": ""},
    ]
    out = S.session_output(S.session_rollup(make_actions(spark, rows), distinct_lists=True)).collect()[0]
    assert out.search_keywords == "a,b"
    # category 0 is a real category; -1 is "no click"
    assert out.click_category_ids == "7,0"
    assert out.step_length == 7
    assert out.start_time == "2024-01-01 00:00:01"


def test_unpadded_and_padded_hours_parse(spark):
    rows = [
        {"action_time": "2024-01-01 5:03:04"},
        {"action_time": "2024-01-01 05:03:09"},
    ]
    out = S.session_rollup(make_actions(spark, rows)).collect()[0]
    assert out.visit_length == 5


def test_user_join_drops_unknown_users(spark):
    acts = make_actions(spark, [{"session_id": "a", "user_id": 1}, {"session_id": "b", "user_id": 2}])
    users = make_users(spark, [(1, 30, "p1", "c1", "male")])
    prof = S.session_profile(S.session_rollup(acts), users)
    assert [r.session_id for r in prof.collect()] == ["a"]


@pytest.fixture()
def profiled(spark):
    rows = [
        {"session_id": "a", "user_id": 1, "search_keyword": "hotpot"},
        {"session_id": "a", "user_id": 1, "click_category_id": 5},
        {"session_id": "b", "user_id": 2, "search_keyword": "cake"},
        {"session_id": "c", "user_id": 3},
        {"session_id": "d", "user_id": 4, "click_category_id": 6},
    ]
    users = make_users(
        spark,
        [(1, 25, "it", "c1", "male"), (2, 55, "law", "c2", "female"), (3, 30, "it", "c1", "female"),
         (4, None, None, None, None)],
    )
    return S.session_profile(S.session_rollup(make_actions(spark, rows)), users)


def _kept(profiled, **kw):
    p = TaskParams(start_date="2024-01-01", end_date="2024-12-31", **kw)
    return sorted(r.session_id for r in S.filter_sessions(profiled, p).collect())


def test_empty_filter_is_identity(profiled):
    assert _kept(profiled) == ["a", "b", "c", "d"]


def test_age_needs_both_bounds(profiled):
    assert _kept(profiled, start_age=20) == ["a", "b", "c", "d"]
    assert _kept(profiled, start_age=20, end_age=40) == ["a", "c"]


def test_any_match_filters(profiled):
    assert _kept(profiled, keywords=["cake", "beer"]) == ["b"]
    assert _kept(profiled, category_ids=[5, 6]) == ["a", "d"]
    assert _kept(profiled, professionals=["it"]) == ["a", "c"]
    assert _kept(profiled, cities=["c2"]) == ["b"]
    assert _kept(profiled, sex="female") == ["b", "c"]
    # null attributes fail a filter that is set
    assert _kept(profiled, sex="female", category_ids=[6]) == []


def test_params_from_reference_json():
    p = TaskParams.from_dict(
        {"startDate": "2020-07-01", "endDate": "2020-07-31", "startAge": 20, "endAge": 50,
         "professionals": "", "cities": "", "sex": "", "keywords": "a, b,", "categoryIds": "1,2",
         "targetPageFlow": "1,2,3"}
    )
    assert p.start_age == 20 and p.end_age == 50
    assert p.professionals == [] and p.sex is None
    assert p.keywords == ["a", "b"] and p.category_ids == [1, 2]
    assert p.page_pairs() == [(1, 1, 2), (2, 2, 3)]
    with pytest.raises(ValueError):
        TaskParams.from_dict({"startDate": "2020-07-01"})


def test_detail_of_filtered_sessions(spark, profiled):
    acts = make_actions(spark, [{"session_id": "a", "user_id": 1}, {"session_id": "z", "user_id": 9}])
    got = S.detail_rows(S.actions_of_sessions(acts, profiled)).collect()
    assert [r.sessionid for r in got] == ["a"]
    assert got[0].clickCategoryId == -1


def test_rollup_without_lists_agrees(spark):
    rows = []
    for n in LENGTHS:
        rows += _session_of_length(f"s{n}", n)
    rows += [{"session_id": "s0", "search_keyword": "a", "click_category_id": 3}]
    acts = make_actions(spark, rows)
    cols = ["session_id", "user_id", "start_time", "visit_length", "step_length"]
    full = S.session_rollup(acts).select(*cols).orderBy("session_id").collect()
    lean = S.session_rollup(acts, with_lists=False).select(*cols).orderBy("session_id").collect()
    assert full == lean
    assert S.session_aggr_stat(S.session_rollup(acts)).collect() == S.session_aggr_stat(
        S.session_rollup(acts, with_lists=False)
    ).collect()


def test_flag_filters_equal_list_filters(spark):
    rows = [
        {"session_id": "a", "user_id": 1, "search_keyword": "hotpot"},
        {"session_id": "a", "user_id": 1, "click_category_id": 5},
        {"session_id": "b", "user_id": 2, "search_keyword": "cake"},
        {"session_id": "c", "user_id": 3},
        {"session_id": "d", "user_id": 4, "click_category_id": 0},
    ]
    acts = make_actions(spark, rows)
    users = make_users(spark, [(u, 30, "it", "c1", "male") for u in (1, 2, 3, 4)])
    for kw in ({"keywords": ["cake", "x"]}, {"category_ids": [0, 5]}, {"keywords": ["hotpot"], "category_ids": [5]}):
        p = TaskParams(start_date="2024-01-01", end_date="2024-12-31", **kw)
        with_lists = S.filter_sessions(S.session_profile(S.session_rollup(acts), users), p)
        lean = S.session_rollup(acts, with_lists=False, keywords=p.keywords, category_ids=p.category_ids)
        with_flags = S.filter_sessions(S.session_profile(lean, users), p)
        assert sorted(r.session_id for r in with_lists.collect()) == sorted(r.session_id for r in with_flags.collect())


def test_lists_keep_repeats_in_time_order(spark, monkeypatch):
    """Q1: repeats stay; pieces of a session (here of two seconds) are put together in order."""
    rows = [
        {"action_time": f"2024-01-01 0:00:{i:02d}", "search_keyword": "abc"[i % 3] if i % 2 else None, "click_category_id": i % 4 if i % 2 == 0 else -1}
        for i in (7, 3, 11, 0, 5, 1, 9, 2, 10, 4, 8, 6)
    ]
    want = None
    for bucket in (600, 2, 1):
        monkeypatch.setattr(S, "LIST_BUCKET", bucket)
        out = S.session_output(S.session_rollup(make_actions(spark, rows).repartition(3))).collect()[0]
        got = (out.search_keywords, out.click_category_ids, out.step_length, out.visit_length)
        assert want is None or got == want
        want = got
    assert want == ("b,a,c,b,a,c", "0,2,0,2,0,2", 12, 11)


def test_no_session_is_sorted_whole(spark):
    plan = S.session_rollup(make_actions(spark, [{"search_keyword": "a"}]))._jdf.queryExecution().optimizedPlan().toString()
    lowest = [line for line in plan.split("\n") if "Aggregate" in line][-1]
    assert "bucket" in lowest or "FLOOR" in lowest
