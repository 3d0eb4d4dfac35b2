"""Running counts as streaming state, with no click lost to the watermark.

A :class:`RunningCount` groups clicks by an event-time window and keys.  Its
streaming frame is a union of two views of the same clicks: the running totals
of the stateful aggregation (update mode: every key a micro-batch touches, with
its new total), and the clicks themselves.  Whether the aggregation drops a
click depends on its window alone, so within a micro-batch the clicks of a
(window, key) are either all in a total or all late: what has clicks but no
total is late, exactly, whatever the watermark was.  Late clicks are stored as
additions, totals as totals; reading takes the last total of each query and
adds what came late.

The state of a window ends when the watermark passes it, so state is bounded by
the open windows; a micro-batch writes what it touched and never reads or
rewrites what is stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from shoplens.sinks.folders import BatchFolder, stored_rows


@dataclass(frozen=True)
class RunningCount:
    """Clicks per window of ``length`` seconds (a new one begins every ``slide``) and keys."""

    keys: tuple[str, ...]
    length: int
    delay: str
    slide: int = 0

    @property
    def step(self) -> int:
        return self.slide or self.length

    def frame(self, clicks: DataFrame) -> DataFrame:
        """Streaming: (total, at, keys..., clickCount, last); ``at`` is the window's start or the click's time."""
        window = F.window("ts", f"{self.length} seconds", f"{self.step} seconds")
        totals = (
            clicks.withWatermark("ts", self.delay)
            .groupBy(window.alias("window"), *self.keys)
            .agg(F.count(F.lit(1)).alias("clickCount"), F.max("ts").alias("last"))
            .select(F.lit(True).alias("total"), F.unix_seconds("window.start").alias("at"), *self.keys, "clickCount", F.unix_seconds("last").alias("last"))
        )
        own = clicks.select(
            F.lit(False).alias("total"), F.unix_seconds("ts").alias("at"), *self.keys, F.lit(1).cast("long").alias("clickCount"),
            F.unix_seconds("ts").alias("last"),
        )
        return totals.unionByName(own)

    def _starts(self, at: Column) -> Column:
        """Starts of the windows that hold a second."""
        newest = F.floor(at / F.lit(self.step)) * F.lit(self.step)
        return F.sequence(newest - F.lit(self.length - self.step), newest, F.lit(self.step))

    def rows(self, batch: DataFrame) -> DataFrame:
        """What a micro-batch stores: (start, keys..., clickCount, last, late, date).

        Clicks are counted per slide before they are put into windows.
        """
        slot = F.when(F.col("total"), F.col("at")).otherwise(F.floor(F.col("at") / F.lit(self.step)) * F.lit(self.step))
        counted = batch.groupBy("total", slot.alias("slot"), *self.keys).agg(F.sum("clickCount").alias("n"), F.max("last").alias("last"))
        starts = F.when(F.col("total"), F.array("slot")).otherwise(self._starts(F.col("slot")))
        each = counted.select("total", F.explode(starts.cast("array<bigint>")).alias("start"), *self.keys, "n", "last")
        met = each.groupBy("start", *self.keys).agg(
            F.max(F.when(F.col("total"), F.col("n"))).alias("state"),
            F.sum(F.when(~F.col("total"), F.col("n"))).alias("own"),
            F.max("last").alias("last"),
        )
        # a day window's date is a key of its own
        day = F.col("date") if "date" in self.keys else F.date_format(F.timestamp_seconds("start"), "yyyy-MM-dd")
        keys = [k for k in self.keys if k != "date"]
        return met.select(
            "start", *keys, F.coalesce("state", "own").alias("clickCount"), "last", F.col("state").isNull().alias("late"), day.alias("date")
        )


def _fields(count: RunningCount, clicks: StructType) -> StructType:
    keys = [clicks[k] for k in count.keys if k != "date"]
    return StructType(
        [StructField("start", LongType()), *keys, StructField("clickCount", LongType()), StructField("last", LongType()), StructField("late", BooleanType()), StructField("date", StringType())]
    )


class RunningTable:
    """Stored totals and late additions of a running count, one partition per (query, batch, date)."""

    def __init__(self, spark: SparkSession, path: str, count: RunningCount, clicks: StructType):
        self.count, self.keys = count, list(dict.fromkeys(["date", "start", *count.keys]))
        self.folder = BatchFolder(spark, path, _fields(count, clicks), "date")

    def store(self, batch: DataFrame, query: str, batch_id: int) -> None:
        self.folder.write(self.count.rows(batch), query, batch_id)

    def totals(self, dates: list[str] | None = None, keys: DataFrame | None = None) -> DataFrame:
        """(date, start, keys..., clickCount, last): the totals of every query, and what came late.

        ``dates`` or ``keys`` (rows of ``self.keys``) narrow the scan to the partitions they name.
        """
        rows = self.folder.read(dates)
        if keys is not None:
            rows = stored_rows(rows, keys, self.keys, "date")
        late = F.col("late")
        # a key's totals only grow while its window is open, and it has none afterwards
        per_query = rows.groupBy("query", *self.keys).agg(
            F.coalesce(F.max(F.when(~late, F.col("clickCount"))), F.lit(0)).alias("state"),
            F.coalesce(F.sum(F.when(late, F.col("clickCount"))), F.lit(0)).alias("more"),
            F.max("last").alias("last"),
        )
        return per_query.groupBy(*self.keys).agg(
            F.sum(F.col("state") + F.col("more")).cast("long").alias("clickCount"), F.max("last").alias("last")
        )
