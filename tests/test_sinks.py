"""Sinks: merges, folders, catalog tables, JDBC, job runners."""

from __future__ import annotations

import uuid

import pytest
from pyspark.errors import AnalysisException

from shoplens.plans import page_job, product_job, session_job
from shoplens.params import TaskParams
from shoplens.sinks.merge import append_new, merge_add, merge_overwrite, replace_groups
from shoplens.sinks.folders import BatchFolder, overwrite_partitions, read_folder, stored_rows, upsert_partitions
from shoplens.sinks.writers import JdbcSink, MemorySink, ParquetSink, TableSink, read_jdbc, with_task_id
from shoplens.sources.adapters import DriverTables
from shoplens.sources.tables import actions_in_range
from tests.conftest import SF_SMALL, sorted_rows

KV = "k string, v long"


def test_merge_algebra(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], KV)
    new = spark.createDataFrame([("b", 5), ("c", 1)], KV)
    assert sorted_rows(merge_overwrite(old, new, ["k"])) == [("a", 1), ("b", 5), ("c", 1)]
    assert sorted_rows(merge_add(old, new, ["k"], "v")) == [("a", 1), ("b", 7), ("c", 1)]
    assert sorted_rows(append_new(old, new, ["k"])) == [("a", 1), ("b", 2), ("c", 1)]


def test_replace_groups(spark):
    schema = "g string, k string, v long"
    old = spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("y", "a", 3)], schema)
    new = spark.createDataFrame([("x", "c", 9)], schema)
    assert sorted_rows(replace_groups(old, new, ["g"])) == [("x", "c", 9), ("y", "a", 3)]


def test_upsert_partitions_rewrites_touched_only(spark, tmp_path):
    path = str(tmp_path / "p")
    schema = "date string, k string, v long"
    upsert_partitions(spark, path, spark.createDataFrame([("d1", "a", 1), ("d2", "a", 1)], schema), ["date", "k"], "date")
    upsert_partitions(spark, path, spark.createDataFrame([("d1", "a", 5), ("d1", "b", 1)], schema), ["date", "k"], "date")
    upsert_partitions(spark, path, spark.createDataFrame([("d1", "a", 5), ("d1", "b", 1)], schema), ["date", "k"], "date")
    got = sorted_rows(spark.read.parquet(path), "date", "k", "v")
    assert got == [("d1", "a", 5), ("d1", "b", 1), ("d2", "a", 1)]


def test_jdbc_roundtrip_embedded_derby(spark):
    # in-process, in-memory Derby: no server, no port
    url = f"jdbc:derby:memory:shoplens{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    sink = JdbcSink(url, props, table_names={"top10_category": "TOP10_CATEGORY"})
    df = spark.createDataFrame([("t", 1, 5, 2, 1)], "taskid string, categoryid long, clickCount long, orderCount long, payCount long")
    sink.write("top10_category", df)
    sink.write("top10_category", df)
    back = read_jdbc(spark, url, "TOP10_CATEGORY", props)
    assert back.count() == 2


def test_jobs_write_reference_tables(spark, tmp_path):
    t = DriverTables(spark, SF_SMALL)
    params = TaskParams(start_date="1970-01-01", end_date="2099-12-31", start_age=20, end_age=50)
    sink = ParquetSink(str(tmp_path / "out"))
    task = session_job.run(spark, t.actions(), t.users(), params, sink, task_id="task-1")
    page_job.run(spark, t.actions(), params, sink, task_id=task)
    product_job.run(spark, t.actions(), t.products(), params, sink, task_id=task)
    out = str(tmp_path / "out")
    stat = spark.read.parquet(out + "/session_aggr_stat").collect()
    assert len(stat) == 1 and stat[0].taskid == "task-1"
    assert spark.read.parquet(out + "/top10_category").count() == 10
    assert spark.read.parquet(out + "/top10_session").count() > 0
    assert spark.read.parquet(out + "/session_detail").count() > 0
    assert spark.read.parquet(out + "/session_random_extract").count() > 0
    packed = spark.read.parquet(out + "/page_split_convert_rate").collect()[0].convertRate
    assert packed.startswith("1_2=") and packed.count("|") == 5
    assert spark.read.parquet(out + "/area_top3_product").columns[:3] == ["taskid", "area", "areaLevel"]


def test_memory_sink_collects_lazy_frames(spark):
    t = DriverTables(spark, SF_SMALL)
    params = TaskParams(start_date="1970-01-01", end_date="2099-12-31")
    sink = MemorySink()
    page_job.run(spark, t.actions(), params, sink, task_id="x")
    assert set(sink.tables) == {"page_split_convert_rate", "page_split_convert_rate_steps"}


def test_table_sink_replaces_a_managed_table(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], KV)
    sink = TableSink(mode="overwrite", prefix="shoplens_test_")
    sink.write("kv", df)
    sink.write("kv", df)  # K8: drop + save, not append
    assert sorted_rows(spark.table("shoplens_test_kv")) == [("a", 1), ("b", 2)]


def test_upsert_of_other_columns_raises_and_keeps_the_stored_rows(spark, tmp_path):
    path = str(tmp_path / "p")
    old = spark.createDataFrame([("d1", "a", 1)], "date string, k string, v long")
    upsert_partitions(spark, path, old, ["date", "k"], "date")
    other = spark.createDataFrame([("d1", "b", 1)], "date string, k string, w long")
    with pytest.raises(AnalysisException):
        upsert_partitions(spark, path, other, ["date", "k"], "date")
    assert sorted_rows(spark.read.parquet(path), "date", "k", "v") == [("d1", "a", 1)]


DATED = "date string, k string, v long"


def _dated(spark, rows):
    return spark.createDataFrame(rows, DATED)


def test_batch_folder_replaces_the_replayed_batch_only(spark, tmp_path):
    folder = BatchFolder(spark, str(tmp_path / "b"), _dated(spark, []).schema, "date")
    assert folder.read().isEmpty() and folder.queries() == [] and not folder.has("q", 0)
    folder.write(_dated(spark, [("d1", "a", 1), ("d2", "a", 1)]), "q", 0)
    folder.write(_dated(spark, [("d1", "a", 2)]), "q", 1)
    folder.write(_dated(spark, [("d1", "a", 4)]), "other", 0)
    # the first batch again, now with fewer dates: nothing of the first try is left
    folder.write(_dated(spark, [("d1", "b", 8)]), "q", 0)
    folder.write(_dated(spark, []), "q", 2)
    rows = sorted_rows(folder.read(), "query", "batch", "date", "k", "v")
    assert rows == [("other", 0, "d1", "a", 4), ("q", 0, "d1", "b", 8), ("q", 1, "d1", "a", 2)]
    assert set(folder.queries()) == {"other", "q"}
    assert folder.complete("q", 2) and not folder.has("q", 3)
    assert sorted_rows(folder.batch("q", 1), "v") == [(2,)]
    assert folder.read(["d2"]).isEmpty()


def test_overwritten_partitions(spark, tmp_path):
    """Rounds replace the groups they touch and leave the others."""
    path = str(tmp_path / "g")
    schema = "date string, province string, adid long"
    overwrite_partitions(spark.createDataFrame([("d1", "x", 1), ("d1", "x", 2), ("d1", "y", 3), ("d2", "x", 4)], schema), path, ["date", "province"])
    for _ in range(2):
        overwrite_partitions(spark.createDataFrame([("d1", "x", 9), ("d3", "z", 5)], schema), path, ["date", "province"])
    got = read_folder(spark, path, spark.createDataFrame([], schema).schema)
    assert sorted_rows(got, "date", "province", "adid") == [("d1", "x", 9), ("d1", "y", 3), ("d2", "x", 4), ("d3", "z", 5)]
    assert read_folder(spark, path + "-absent", got.schema).isEmpty()


def test_stored_rows_scan_the_partitions_of_their_keys(spark, tmp_path):
    path = str(tmp_path / "s")
    overwrite_partitions(_dated(spark, [(f"d{i}", k, i) for i in range(9) for k in "ab"]), path, ["date"])
    keys = _dated(spark, [("d3", "a", 0), ("d3", "a", 0), ("d5", "z", 0), ("d7", "b", 0), (None, "a", 0)])
    found = stored_rows(read_folder(spark, path, keys.schema), keys, ["date", "k"], "date")
    assert sorted_rows(found, "date", "k", "v") == [("d3", "a", 3), ("d7", "b", 7)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert all(d in filters for d in ("d3", "d5", "d7")) and "d4" not in filters


def test_partitioned_catalog_table_is_pruned(spark, tmp_path):
    """A table saved by date, stamped with the task, scanned by a date range."""
    sink = TableSink("overwrite", "shoplens_test_", {"dated": ["date"]}, str(tmp_path / "tables"))
    rows = _dated(spark, [(f"2024-01-0{i}", "a", i) for i in range(1, 9)])
    sink.write("dated", with_task_id(rows, "t"))
    sink.write("dated", with_task_id(rows, "t"))  # replaced, not appended
    table = spark.table("shoplens_test_dated")
    params = TaskParams(start_date="2024-01-03", end_date="2024-01-05")
    ranged = actions_in_range(table, params)
    assert sorted_rows(ranged, "taskid", "date", "k", "v") == [("t", f"2024-01-0{i}", "a", i) for i in (3, 4, 5)]
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "2024-01-03" in filters and "2024-01-05" in filters
