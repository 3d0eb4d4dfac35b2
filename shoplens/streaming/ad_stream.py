"""Real-time ad analytics with Structured Streaming.

Named queries, each with its own checkpoint (offsets and state survive restarts
and lost executors, Q18); outputs are plain partitioned folders
(:mod:`shoplens.sinks.folders`):

``ad_blacklist``
    Running clicks per (day, user, ad) as state.  Users over the threshold that
    are not listed yet are appended (Q15).
``ad_filter``
    Drops clicks of blacklisted users: a real anti join (Q14) with the list as
    it stands when the micro-batch begins, so a list that grows between batches
    takes effect (R3).  What a batch keeps is decided once and stored.
``ad_stat``, ``ad_province``
    Running clicks per (date, province, city, ad) and per (date, province, ad)
    of the kept clicks, as state (R5).  ``ad_province`` also keeps the top-3 of
    every (date, province) it touches: totals only grow, so the new top-3 is
    among the old one and the updated totals, and unchanged ads keep their
    place; those partitions are overwritten (K12, Q13).
``ad_trend``
    Event-time one-minute windows per ad (Q12).  Not blacklist-filtered, as in
    the reference, unless asked.
``ad_trailing_hour``
    Event-time windows of 60 minutes, one every minute, per ad (R7).

Clicks behind a watermark are added to every output (see
:mod:`shoplens.streaming.running`), so outputs agree however late a click is.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from shoplens.operators import ads as A
from shoplens.schemas import AD_BLACKLIST, AD_CLICK, AD_PROVINCE_TOP3
from shoplens.sinks.folders import BatchFolder, make_folder, overwrite_partitions, read_folder
from shoplens.sinks.merge import replace_groups
from shoplens.spark import ensure_checkpoint_dir
from shoplens.streaming.running import RunningCount, RunningTable

DAY, HOUR, MINUTE = 86_400, 3_600, 60
#: A decoded, valid click as the queries see it.
CLICK = StructType([*AD_CLICK.fields, StructField("ts", TimestampType()), StructField("date", StringType())])


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Ad log lines from text files arriving in ``path`` (column ``value``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                 **options) -> DataFrame:
    """Ad log lines from Kafka (needs the spark-sql-kafka package)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for k, v in options.items():
        reader = reader.option(k, v)
    try:
        stream = reader.load()
    except Exception as exc:  # the connector is a separate package
        if "kafka" in str(exc).lower():
            raise RuntimeError(
                "the Kafka source needs the spark-sql-kafka package on the classpath "
                "(spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_<scala>:<spark version>)"
            ) from exc
        raise
    return stream.selectExpr("CAST(value AS STRING) AS value")


def write_log(lines: DataFrame, folder: str) -> None:
    """Add log lines to a folder that a file source reads: one write, as many files as ``lines`` has partitions."""
    lines.select("value").write.mode("append").text(folder)


COUNTS = {
    "ad_blacklist": RunningCount(("date", "userid", "adid"), DAY, "25 hours"),
    "ad_stat": RunningCount(("date", "province", "city", "adid"), DAY, "25 hours"),
    "ad_province": RunningCount(("date", "province", "adid"), DAY, "25 hours"),
    "ad_trend": RunningCount(("adid",), MINUTE, "1 hour"),
    "ad_trailing_hour": RunningCount(("adid",), HOUR, "1 hour", MINUTE),
}


@dataclass
class AdTables:
    """The stored outputs of the ad stream: folders, and what they add up to."""

    spark: SparkSession
    root: str

    @classmethod
    def at(cls, spark: SparkSession, root: str) -> "AdTables":
        return cls(spark, root.rstrip("/"))

    def running(self, name: str) -> RunningTable:
        return RunningTable(self.spark, f"{self.root}/{name}_counts", COUNTS[name], CLICK)

    @property
    def listed(self) -> BatchFolder:
        return BatchFolder(self.spark, f"{self.root}/ad_blacklist", AD_BLACKLIST)

    @property
    def kept(self) -> BatchFolder:
        return BatchFolder(self.spark, f"{self.root}/ad_kept", CLICK)

    @property
    def top3_path(self) -> str:
        return f"{self.root}/ad_province_top3"

    def user_click_count(self) -> DataFrame:
        return self.running("ad_blacklist").totals().select("date", "userid", "adid", "clickCount")

    def blacklist(self) -> DataFrame:
        return self.listed.read().select("userid").distinct()

    def stat(self) -> DataFrame:
        return self.running("ad_stat").totals().select("date", "province", "city", "adid", "clickCount")

    def province_top3(self) -> DataFrame:
        return read_folder(self.spark, self.top3_path, AD_PROVINCE_TOP3)

    def click_trend(self) -> DataFrame:
        rows = self.running("ad_trend").totals()
        return A.trend_rows(rows.withColumn("minute_ts", F.timestamp_seconds("start")))

    def trailing_hour(self) -> DataFrame:
        """Clicks of the 60 minutes that end with each minute in which an ad was clicked."""
        rows = self.running("ad_trailing_hour").totals()
        newest = F.col("start") + F.lit(HOUR - MINUTE)
        return rows.where(F.col("last") >= newest).select(
            F.date_format(F.timestamp_seconds(newest), "yyyy-MM-dd HH:mm").alias("minute"),
            "adid",
            F.col("clickCount").alias("windowCount"),
        )


# ---- foreachBatch handlers ----

Handler = Callable[[DataFrame, int, str], None]


def _with_query_id(handler: Handler):
    """The handler also gets the id of its streaming query, which lives in the
    query's checkpoint: batch ids count per query."""

    def run(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        handler(batch, batch_id, query or "none")

    return run


def store_counts(tables: AdTables, name: str) -> Handler:
    """Store the totals and late clicks of a micro-batch."""

    def handler(batch: DataFrame, batch_id: int, query: str) -> None:
        tables.running(name).store(batch, query, batch_id)

    return handler


def _others(table: RunningTable, query: str) -> bool:
    """Have other queries (an earlier checkpoint) written to the same table?"""
    return any(q != query for q in table.folder.queries())


def store_user_counts(tables: AdTables, threshold: int) -> Handler:
    """Store user counts, then append users over the threshold that are not listed."""

    def handler(batch: DataFrame, batch_id: int, query: str) -> None:
        table = tables.running("ad_blacklist")
        table.store(batch, query, batch_id)
        written = table.folder.batch(query, batch_id)
        # a total in this batch is the whole total, unless it came late or an earlier query counted too
        unsure = written if _others(table, query) else written.where("late")
        totals = written.where("not late").select("userid", "clickCount")
        if not unsure.isEmpty():
            totals = totals.unionByName(table.totals(keys=unsure).select("userid", "clickCount"))
        offenders = A.blacklist_users(totals, threshold)
        # users that an earlier try of this batch listed are listed again, in the same partition
        known = tables.listed.read().where(~((F.col("query") == query) & (F.col("batch") == batch_id)))
        fresh = offenders.join(known.select("userid"), "userid", "left_anti")
        if tables.listed.has(query, batch_id) or not fresh.isEmpty():
            tables.listed.write(fresh, query, batch_id)

    return handler


def keep_clicks(tables: AdTables) -> Handler:
    """Store the clicks of users that are not on the list now.  A replay keeps what was kept before."""

    def handler(batch: DataFrame, batch_id: int, query: str) -> None:
        if not tables.kept.complete(query, batch_id):
            tables.kept.write(A.exclude_blacklisted(batch, tables.blacklist()).select(*CLICK.names), query, batch_id)

    return handler


def store_province_counts(tables: AdTables) -> Handler:
    """Store province counts, then overwrite the top-3 of the touched (date, province)."""

    def handler(batch: DataFrame, batch_id: int, query: str) -> None:
        table = tables.running("ad_province")
        table.store(batch, query, batch_id)
        written = table.folder.batch(query, batch_id).select("date", "province", "adid", "clickCount", "late")
        unsure = written if _others(table, query) else written.where("late")
        groups = ["date", "province"]
        sure = written.where("not late").drop("late")
        # stored winners whose total is not new still hold their old total
        old = tables.province_top3().join(sure, [*groups, "adid"], "left_anti")
        old = old.join(sure.select(*groups).distinct(), groups, "left_semi")
        top = A.province_top3(old.unionByName(sure))
        again = unsure.select(*groups).distinct()
        if not again.isEmpty():
            # late clicks, or totals of an earlier query: those groups anew from the stored totals of their dates
            dates = sorted(r[0] for r in again.select("date").distinct().collect())
            stored = table.totals(dates).join(again, groups, "left_semi")
            top = replace_groups(top, A.province_top3(stored), groups)
        # the rewrite must not read the partitions it replaces
        overwrite_partitions(top.select(*AD_PROVINCE_TOP3.names).checkpoint(eager=True), tables.top3_path, groups)

    return handler


QUERY_NAMES = ("ad_blacklist", "ad_filter", "ad_stat", "ad_province", "ad_trend", "ad_trailing_hour")
#: Queries that read what ``ad_filter`` keeps.
OF_KEPT = ("ad_stat", "ad_province")
# optional: malformed log lines appended to <output_root>/ad_rejects
REJECTS = "ad_rejects"


def _session(spark: SparkSession, state_partitions: int | None) -> SparkSession:
    """A session of the same context whose streaming queries keep their state in so many partitions.

    The number is fixed when a checkpoint is made; choose it by the expected
    state, not by a batch.  Batches without data have nothing to do in update
    mode: what the watermark has closed is dropped with the next data.
    """
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def start_ad_queries(
    spark: SparkSession,
    lines: Callable[[SparkSession], DataFrame],
    output_root: str,
    checkpoint_root: str | None = None,
    threshold: int = 100,
    trigger: dict | None = None,
    names: tuple[str, ...] = QUERY_NAMES,
    name_suffix: str = "",
    filter_trend: bool = False,
    state_partitions: int | None = None,
) -> dict[str, StreamingQuery]:
    """Start the named queries over ``lines(session)``; ``trigger`` defaults to the reference's 5 s batches.

    Checkpoints go under ``checkpoint_root``, by default the cluster's
    shared checkpoint folder.  ``filter_trend``: the trend and the trailing
    hour count kept clicks only (Q12).
    """
    checkpoint_root = (checkpoint_root or os.path.join(ensure_checkpoint_dir(spark), "ad-stream")).rstrip("/")
    ensure_checkpoint_dir(spark)
    trigger = trigger or {"processingTime": "5 seconds"}
    session = _session(spark, state_partitions)
    tables = AdTables.at(session, output_root)
    started = {}

    def start(name: str, df: DataFrame, mode: str, handler: Handler) -> None:
        started[name] = (
            df.writeStream.queryName(name + name_suffix)
            .outputMode(mode)
            .option("checkpointLocation", f"{checkpoint_root}/{name}")
            .foreachBatch(_with_query_id(handler))
            .trigger(**trigger)
            .start()
        )

    def valid() -> DataFrame:
        return A.split_valid(A.decode_ad_log(lines(session)))[0]

    def kept() -> DataFrame:
        make_folder(session, tables.kept.path)
        return session.readStream.schema(tables.kept.schema).parquet(tables.kept.path).select(*CLICK.names)

    if REJECTS in names:
        # plain file sink: exactly-once appends through its own checkpoint
        started[REJECTS] = (
            A.split_valid(A.decode_ad_log(lines(session)))[1]
            .writeStream.queryName(REJECTS + name_suffix)
            .format("parquet")
            .option("path", f"{output_root.rstrip('/')}/{REJECTS}")
            .option("checkpointLocation", f"{checkpoint_root}/{REJECTS}")
            .trigger(**trigger)
            .start()
        )
    handlers = {"ad_blacklist": store_user_counts(tables, threshold), "ad_province": store_province_counts(tables)}
    for name in [n for n in names if n != REJECTS]:
        if name == "ad_filter":
            start(name, valid(), "append", keep_clicks(tables))
            continue
        of_kept = name in OF_KEPT or filter_trend and name in ("ad_trend", "ad_trailing_hour")
        frame = COUNTS[name].frame(kept() if of_kept else valid())
        start(name, frame, "update", handlers.get(name) or store_counts(tables, name))
    return started


def run_available(spark: SparkSession, source_path: str, output_root: str, checkpoint_root: str,
                  threshold: int = 100, max_files_per_trigger: int | None = None,
                  names: tuple[str, ...] = QUERY_NAMES, filter_trend: bool = False,
                  state_partitions: int | None = None) -> AdTables:
    """Process everything in ``source_path`` now, then stop (tests, backfills).

    The named queries run one after another: the blacklist to completion
    first, so the clicks are filtered by the list as it is then -- over a
    finished log the same result as the batch twin.
    """
    # active query names must be unique in a session: one suffix per run
    suffix = "_" + uuid.uuid4().hex[:8]
    for name in [n for n in QUERY_NAMES + (REJECTS,) if n in names]:
        start_ad_queries(
            spark, lambda s: file_source(s, source_path, max_files_per_trigger), output_root, checkpoint_root, threshold,
            {"availableNow": True}, (name,), suffix, filter_trend, state_partitions,
        )[name].awaitTermination()
    return AdTables.at(spark, output_root)
