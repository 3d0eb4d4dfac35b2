"""Stream = batch: the ad stream over files gives the batch twin's tables (§5 layer 4)."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shoplens.operators import ads as A
from shoplens.plans import ad_job
from shoplens.streaming import ad_stream as ST
from tests.conftest import SF_SMALL, sorted_rows

DAY1 = 1704067200000
MINUTE = 60_000
DAY = 86_400_000


def _lines():
    lines = []
    # user 7 clicks ad 1 three times on day 1 -> offender at threshold 2
    lines += [f"{DAY1 + i * MINUTE} p1 c1 7 1" for i in range(3)]
    lines += [f"{DAY1 + i * MINUTE} p1 c2 8 {i % 6}" for i in range(12)]
    lines += [f"{DAY1 + DAY + i * MINUTE} p2 c3 9 {i % 3}" for i in range(5)]
    lines += ["not a click"]
    return lines


class Stream:
    """Log folder, outputs and checkpoints; every round adds lines and runs the queries anew from their checkpoints."""

    def __init__(self, spark, root, threshold=2):
        self.spark, self.root, self.threshold, self.lines = spark, str(root), threshold, []

    def add(self, lines, names=ST.QUERY_NAMES, checkpoint="ckpt", **options):
        self.lines += lines
        ST.write_log(self.spark.createDataFrame([(x,) for x in lines], "value string").repartition(2), self.root + "/in")
        return self.run(names, checkpoint, **options)

    def run(self, names=ST.QUERY_NAMES, checkpoint="ckpt", **options):
        return ST.run_available(self.spark, self.root + "/in", self.root + "/out", f"{self.root}/{checkpoint}", self.threshold, names=names, state_partitions=2, **options)

    def batch(self, lines=None, **options):
        return ad_job.build(self.spark.createDataFrame([(x,) for x in lines or self.lines], "value string"), self.threshold, **options)

    def clicks(self):
        return A.split_valid(A.decode_ad_log(self.spark.createDataFrame([(x,) for x in self.lines], "value string")))[0]


def same(got, want):
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted_rows(got, *cols) == sorted_rows(want, *cols)


def agree(tables, stream):
    """Every output equals the batch twin over all lines so far."""
    batch = stream.batch()
    same(tables.blacklist(), batch.blacklist)
    same(tables.user_click_count(), batch.user_click_count)
    same(tables.stat(), batch.stat)
    same(tables.province_top3(), batch.province_top3)
    same(tables.click_trend(), batch.click_trend)
    same(tables.trailing_hour(), A.trailing_hour(A.minute_counts(stream.clicks())))


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_stream_equals_batch(spark, tmp_path, per_trigger):
    stream = Stream(spark, tmp_path)
    tables = stream.add(_lines(), max_files_per_trigger=per_trigger)
    assert sorted_rows(tables.blacklist()) == [(7,)]
    agree(tables, stream)


def test_restarts_and_clicks_that_come_days_late(spark, tmp_path):
    """Five rounds, each a restart: keys go on over rounds, and late clicks reach every output."""
    stream = Stream(spark, tmp_path, threshold=100)
    hour = 60 * MINUTE
    stream.add([f"{DAY1 + i * 7 * MINUTE} p{i % 2} c{i % 3} {i % 5} {i % 4}" for i in range(40)])
    # the same keys again: one window of an ad spans three rounds
    stream.add([f"{DAY1 + 2 * hour + i * 11 * MINUTE} p{i % 2} c{i % 3} {i % 5} {i % 4}" for i in range(30)])
    tables = stream.add([f"{DAY1 + 3 * DAY} p1 c1 1 1", f"{DAY1 + 2 * hour + 30 * MINUTE} p0 c0 1 3"])
    agree(tables, stream)
    assert tables.running("ad_stat").folder.read().where("late").isEmpty()
    # clicks are late from the second batch after the one that moved the watermark
    stream.add([f"{DAY1 + 3 * DAY} p1 c1 1 2"])
    # three days behind: its day and its hour are closed, and new keys among them
    tables = stream.add([f"{DAY1} p0 c0 0 0", f"{DAY1} p0 c0 0 0", f"{DAY1 + 5 * MINUTE} p9 c9 9 19", f"{DAY1 + 3 * DAY} p1 c1 1 1"])
    for name in ("ad_blacklist", "ad_stat", "ad_province", "ad_trend", "ad_trailing_hour"):
        assert not tables.running(name).folder.read().where("late").isEmpty(), name
    agree(tables, stream)


def test_late_clicks_make_offenders(spark, tmp_path):
    stream = Stream(spark, tmp_path, threshold=3)
    stream.add([f"{DAY1} p c 5 1"] * 2 + [f"{DAY1 + 5 * DAY} p c 6 1"])
    tables = stream.add([f"{DAY1 + MINUTE} p c 5 1", f"{DAY1 + 5 * DAY} p c 6 1"])
    assert sorted_rows(tables.blacklist()) == []
    tables = stream.add([f"{DAY1 + 2 * MINUTE} p c 5 1"])
    assert sorted_rows(tables.blacklist()) == [(5,)]
    same(tables.user_click_count(), stream.batch().user_click_count)


def test_blacklist_grows_between_batches(spark, tmp_path):
    """A batch is filtered by the list as it stands when the batch begins."""
    stream = Stream(spark, tmp_path, threshold=1)
    first = [f"{DAY1} p c 5 1"] * 2 + [f"{DAY1} p c 6 1"]
    second = [f"{DAY1 + MINUTE} p c 5 1", f"{DAY1 + MINUTE} p c 6 2", f"{DAY1 + MINUTE} p c 6 1"]
    third = [f"{DAY1 + 2 * MINUTE} p c 5 1", f"{DAY1 + 2 * MINUTE} p c 6 1", f"{DAY1 + 2 * MINUTE} p c 7 1"]
    for lines in (first, second, third):
        stream.add(lines, ("ad_filter",))
        tables = stream.run(("ad_blacklist", "ad_stat"))
    # 5 is listed after the first batch, 6 after the second
    counts = {r.adid: r.clickCount for r in tables.stat().collect()}
    assert counts == {1: 3 + 1 + 1, 2: 1}
    assert sorted_rows(tables.blacklist()) == [(5,), (6,)]


def test_trend_of_kept_clicks(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    tables = stream.add(_lines(), ("ad_blacklist", "ad_filter", "ad_trend"), filter_trend=True)
    same(tables.click_trend(), stream.batch(filter_trend=True).click_trend)


def _batch_of(spark, lines):
    """What a micro-batch of a first batch looks like: all clicks, and their totals."""
    clicks, _ = A.split_valid(A.decode_ad_log(spark.createDataFrame([(x,) for x in lines], "value string")))
    return clicks


def _frame(clicks, count):
    seconds = F.unix_seconds("ts")
    start = F.floor(seconds / F.lit(count.length)) * F.lit(count.length)
    totals = clicks.groupBy(start.alias("at"), *count.keys).agg(F.count("*").alias("clickCount"), F.max(seconds).alias("last"))
    own = clicks.select(F.lit(False).alias("total"), seconds.alias("at"), *count.keys, F.lit(1).cast("long").alias("clickCount"), seconds.alias("last"))
    return totals.withColumn("total", F.lit(True)).unionByName(own)


def test_replayed_batches_count_once(spark, tmp_path):
    tables = ST.AdTables.at(spark, str(tmp_path / "out"))
    clicks = _batch_of(spark, [f"{DAY1} p c 1 1", f"{DAY1} p c 2 1", f"{DAY1} p c 2 1"])
    users, province = ST.store_user_counts(tables, 1), ST.store_province_counts(tables)
    for _ in range(2):  # the same micro-batch delivered again
        users(_frame(clicks, ST.COUNTS["ad_blacklist"]), 0, "q")
        assert sorted_rows(tables.blacklist()) == [(2,)]
        ST.keep_clicks(tables)(clicks, 0, "f")
        ST.store_counts(tables, "ad_stat")(_frame(clicks, ST.COUNTS["ad_stat"]), 0, "q")
        province(_frame(clicks, ST.COUNTS["ad_province"]), 0, "q")
        assert [r.clickCount for r in tables.stat().collect()] == [3]
        assert [r.clickCount for r in tables.province_top3().collect()] == [3]
        assert sorted(r.userid for r in tables.kept.read().collect()) == [1]
    # another query (a new checkpoint) adds its totals
    ST.store_counts(tables, "ad_stat")(_frame(clicks, ST.COUNTS["ad_stat"]), 0, "other")
    assert [r.clickCount for r in tables.stat().collect()] == [6]


def test_new_checkpoint_over_an_old_output_adds_its_batches(spark, tmp_path):
    stream = Stream(spark, tmp_path, threshold=100)
    names = ("ad_blacklist", "ad_filter", "ad_stat", "ad_province")
    lines = _lines()
    stream.add(lines[:10], names, "ckpt1")
    other = Stream(spark, tmp_path / "more", threshold=100)
    ST.write_log(spark.createDataFrame([(x,) for x in lines[10:]], "value string"), other.root + "/in")
    out = stream.root + "/out"
    ST.run_available(spark, other.root + "/in", out, other.root + "/ckpt", 100, names=("ad_blacklist", "ad_filter"), state_partitions=2)
    tables = ST.run_available(spark, other.root + "/in", out, stream.root + "/ckpt1", 100, names=("ad_stat", "ad_province"), state_partitions=2)
    batch = stream.batch(lines)
    same(tables.stat(), batch.stat)
    same(tables.province_top3(), batch.province_top3)
    same(tables.user_click_count(), batch.user_click_count)


def test_stored_counts_are_looked_up_in_their_partitions(spark, tmp_path):
    """Only the dates of the keys are read."""
    stream = Stream(spark, tmp_path, threshold=100)
    tables = stream.add([f"{DAY1 + d * DAY} p c {u} 1" for d in range(5) for u in range(3) for _ in range(u + 1)], ("ad_blacklist",))
    table = tables.running("ad_blacklist")
    keys = table.totals().where("date = '2024-01-03' and userid < 2").select(*table.keys)
    found = table.totals(keys=keys)
    assert sorted_rows(found, "date", "userid", "clickCount") == [("2024-01-03", 0, 1), ("2024-01-03", 1, 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-03" in plan


def test_a_batch_does_not_read_what_is_stored(spark, tmp_path):
    """Storing counts plans no read of stored files."""
    tables = ST.AdTables.at(spark, str(tmp_path / "out"))
    clicks = _batch_of(spark, [f"{DAY1} p c 1 1"])
    count = ST.COUNTS["ad_stat"]
    ST.store_counts(tables, "ad_stat")(_frame(clicks, count), 0, "q")
    plan = count.rows(_frame(clicks, count))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_driver_stream_queries_match_batch(spark):
    import __spark_entry__ as E

    qs = E.queries()
    for stream_name, batch_name in [("stream_ad_stat", "ad_stat"), ("stream_ad_trend", "ad_click_trend"),
                                    ("stream_blacklist", "ad_blacklist"), ("stream_ad_trailing_hour", "ad_trailing_hour")]:
        same(qs[stream_name](spark, SF_SMALL), qs[batch_name](spark, SF_SMALL))


def test_kafka_source_reports_a_missing_connector(spark):
    try:
        df = ST.kafka_source(spark, "localhost:9", "ad-log")
    except RuntimeError as exc:
        assert "spark-sql-kafka" in str(exc)
    else:  # connector present: the source is defined lazily, nothing connects yet
        assert df.columns == ["value"] and df.isStreaming


def test_rejected_lines_are_kept(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.add([f"{DAY1} p c 1 1", "garbage", f"{DAY1} p c x 1"], (ST.REJECTS,))
    stream.add(_lines(), (ST.REJECTS,))
    kept = sorted(r.raw for r in spark.read.parquet(stream.root + "/out/ad_rejects").collect())
    assert kept == [f"{DAY1} p c x 1", "garbage", "not a click"]


def test_default_trigger_is_every_five_seconds(spark, tmp_path):
    """Without a trigger a batch begins every five seconds, and new files are taken up by the next one."""
    stream = Stream(spark, tmp_path)
    ST.write_log(spark.createDataFrame([(x,) for x in _lines()], "value string"), stream.root + "/in")
    (query,) = ST.start_ad_queries(
        spark, lambda s: ST.file_source(s, stream.root + "/in"), stream.root + "/out", stream.root + "/ckpt", names=("ad_trend",), state_partitions=2,
        name_suffix="_every_five",
    ).values()
    try:
        query.processAllAvailable()
        ST.write_log(spark.createDataFrame([(f"{DAY1} p c 1 19",)], "value string"), stream.root + "/in")
        query.processAllAvailable()
        began = [datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")) for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    assert len(began) == 2
    # batches begin on the five seconds
    assert began[1] - began[0] >= timedelta(seconds=4.5) and began[1].second % 5 == 0 and began[1].microsecond < 500_000
