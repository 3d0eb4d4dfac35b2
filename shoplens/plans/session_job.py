"""Session job: statistics, sample, top categories, top sessions.

Plan shape: actions are scanned with only the needed columns and the date
predicate pushed into the scan; the session roll-up is two combinable
aggregations; the filtered session table (which feeds four outputs) and the
aggregate by (category, session) (which feeds both rankings) are each
materialised once in the shared checkpoint folder.  The rest are one global
aggregate, one windowed sample, one top-k and one per-group top-k.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators import categories as C
from shoplens.operators import sampling as SM
from shoplens.operators import sessions as S
from shoplens.params import TaskParams
from shoplens.sinks.writers import with_task_id
from shoplens.sources.tables import actions_in_range
from shoplens.spark import broadcast_rows, cut_lineage


@dataclass
class SessionJobResult:
    aggr_stat: DataFrame
    random_extract: DataFrame
    sample_detail: DataFrame
    top10_category: DataFrame
    top10_session: DataFrame
    top10_detail: DataFrame


def build(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    sample_total: int = 100,
    seed: str = "shoplens",
    strict_reference: bool = False,
    dedupe_detail: bool = False,
) -> SessionJobResult:
    """Lazy outputs over the materialised sessions and category counts.

    The session table carries no lists: the keyword / category filters are
    boolean aggregates, and lists are built only for the sampled sessions.
    """
    ranged = actions_in_range(actions, params)
    rolled = S.session_rollup(ranged, with_lists=False, keywords=params.keywords, category_ids=params.category_ids)
    filtered = cut_lineage(S.filter_sessions(S.session_profile(rolled, users), params))
    counted = cut_lineage(C.category_session_counts(S.actions_of_sessions(ranged, filtered)))

    sample = SM.stratified_sample(filtered, sample_total, seed)
    # sample_total sessions at most
    sample_actions = ranged.join(broadcast_rows(sample.select("session_id"), sample_total), "session_id", "left_semi")
    sample = sample.join(S.session_lists(sample_actions), "session_id", "left").select(
        "session_id",
        "start_time",
        F.coalesce("search_keywords", F.array().cast("array<string>")).alias("search_keywords"),
        F.coalesce("click_category_ids", F.array().cast("array<bigint>")).alias("click_category_ids"),
    )
    top10 = C.top_categories(C.category_totals(counted, strict_reference))
    top_sessions = C.rank_sessions(counted, top10)
    return SessionJobResult(
        aggr_stat=S.session_aggr_stat(filtered),
        random_extract=SM.sample_output(sample),
        sample_detail=S.detail_rows(sample_actions),
        top10_category=top10,
        top10_session=top_sessions,
        top10_detail=S.detail_rows(C.top_session_actions(ranged, top_sessions, dedupe_detail)),
    )


def run(spark, actions: DataFrame, users: DataFrame, params: TaskParams, sink, task_id: str | None = None,
        **options) -> str:
    """Compute and write the six outputs under the reference's table names."""
    task_id = task_id or str(uuid.uuid4())
    result = build(actions, users, params, **options)
    sink.write("session_aggr_stat", with_task_id(result.aggr_stat, task_id))
    sink.write("session_random_extract", with_task_id(result.random_extract, task_id))
    sink.write("session_detail", with_task_id(result.sample_detail, task_id))
    sink.write("top10_category", with_task_id(result.top10_category, task_id))
    sink.write("top10_session", with_task_id(result.top10_session, task_id))
    sink.write("session_detail", with_task_id(result.top10_detail, task_id))
    return task_id
