"""Page-flow conversion job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from shoplens.operators import funnel as FN
from shoplens.params import TaskParams
from shoplens.sinks.writers import with_task_id
from shoplens.sources.tables import actions_in_range


def build(actions: DataFrame, params: TaskParams) -> tuple[DataFrame, DataFrame]:
    """(per-step rates in flow order, the packed one-row ``convertRate``)."""
    rates = FN.page_convert_rate(actions_in_range(actions, params), params)
    return rates, FN.packed_convert_rate(rates)


def run(spark, actions: DataFrame, params: TaskParams, sink, task_id: str | None = None) -> str:
    task_id = task_id or str(uuid.uuid4())
    rates, packed = build(actions, params)
    sink.write("page_split_convert_rate", with_task_id(packed, task_id))
    sink.write("page_split_convert_rate_steps", with_task_id(rates, task_id))
    return task_id
