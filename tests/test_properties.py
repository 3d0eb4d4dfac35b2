"""Property tests against brute force on small random fixtures."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplens.operators import funnel as FN
from shoplens.operators import sampling as SM
from shoplens.operators import sessions as S
from tests.conftest import make_actions

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


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


action = st.tuples(st.integers(0, 3), st.integers(0, 3599), st.integers(0, 5))


@SETTINGS
@given(
    acts=st.lists(action, min_size=1, max_size=80),
    hot=st.integers(0, 150),
    width=st.integers(1, 4000),
)
def test_page_pairs_match_brute_force(spark, acts, hot, width):
    rows = [
        {"session_id": f"s{s}", "page_id": p, "action_time": f"2024-01-01 0:{t // 60:02d}:{t % 60:02d}"}
        for s, t, p in acts
    ]
    # one hot session with many actions, to be cut into buckets
    rows += [
        {"session_id": "hot", "page_id": (i * 7) % 6, "action_time": f"2024-01-01 0:{(i % 3600) // 60:02d}:{i % 60:02d}"}
        for i in range(hot)
    ]
    got = {
        (r.from_page, r.to_page): r.pair_count
        for r in FN.page_pair_counts(make_actions(spark, rows), bucket_seconds=width).collect()
    }
    assert got == _brute_pairs(rows)


@SETTINGS
@given(
    spec=st.lists(st.tuples(st.integers(1, 4), st.integers(0, 23), st.integers(1, 12)), min_size=1, max_size=8),
    total=st.integers(1, 120),
)
def test_sample_sizes_follow_the_quota_rule(spark, spec, total):
    counts = {}
    for day, hour, n in spec:
        counts[(day, hour)] = counts.get((day, hour), 0) + n
    rows = []
    for (day, hour), n in counts.items():
        for i in range(n):
            rows.append({"session_id": f"{day}-{hour}-{i}", "date": f"2024-01-0{day}",
                         "action_time": f"2024-01-0{day} {hour}:00:00"})
    sessions = S.session_rollup(make_actions(spark, rows), with_lists=False)
    sample = SM.stratified_sample(sessions, total, "p")
    got = {}
    for r in sample.select(F.date_format("start_ts", "yyyy-MM-dd").alias("d"), F.hour("start_ts").alias("h")).collect():
        key = (int(r.d[-1]), r.h)
        got[key] = got.get(key, 0) + 1
    per_day = {}
    for (d, _), n in counts.items():
        per_day[d] = per_day.get(d, 0) + n
    assert sum(got.values()) == min(total, sum(counts.values()))
    day_got = {d: sum(n for (dd, _), n in got.items() if dd == d) for d in per_day}
    # days share evenly: a day below another's share has no session left
    for d, n in day_got.items():
        assert n == per_day[d] or n >= max(day_got.values()) - 1
    # hours are within one place of their share of the day
    for (d, h), n in counts.items():
        assert abs(got.get((d, h), 0) - day_got[d] * n / per_day[d]) < 1
