"""Output sinks for the batch jobs (K1-K8).

A sink receives named result DataFrames.  Writers are plain Spark writers:
parquet folders (``append`` like the reference's JDBC appends, or
``overwrite``), catalog tables, or JDBC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    """Stamp the task id as the first column."""
    return df.select(F.lit(task_id).alias("taskid"), *df.columns)


class ParquetSink:
    def __init__(self, root: str, mode: str = "append"):
        self.root = root.rstrip("/")
        self.mode = mode

    def write(self, name: str, df: DataFrame) -> None:
        df.write.mode(self.mode).parquet(f"{self.root}/{name}")


class TableSink:
    """K8: catalog tables; ``overwrite`` replaces the table (drop + save).

    ``partition_by`` names partition columns per table; ``location`` is a
    folder for external tables (default: the catalog's warehouse).
    """

    def __init__(self, mode: str = "append", prefix: str = "", partition_by: dict[str, list[str]] | None = None,
                 location: str | None = None):
        self.mode = mode
        self.prefix = prefix
        self.partition_by = partition_by or {}
        self.location = location.rstrip("/") if location else None

    def write(self, name: str, df: DataFrame) -> None:
        writer = df.write.mode(self.mode)
        if self.partition_by.get(name):
            writer = writer.partitionBy(*self.partition_by[name])
        if self.location:
            writer = writer.option("path", f"{self.location}/{self.prefix}{name}")
        writer.saveAsTable(self.prefix + name)


class JdbcSink:
    """K1-K7: JDBC append, batched per partition by Spark's JDBC writer."""

    def __init__(self, url: str, properties: dict[str, str] | None = None, batch_size: int = 1000,
                 table_names: dict[str, str] | None = None):
        self.url = url
        self.properties = dict(properties or {})
        self.batch_size = batch_size
        self.table_names = table_names or {}

    def write(self, name: str, df: DataFrame, mode: str = "append") -> None:
        (
            df.write.format("jdbc")
            .option("url", self.url)
            .option("dbtable", self.table_names.get(name, name))
            .option("batchsize", str(self.batch_size))
            .options(**self.properties)
            .mode(mode)
            .save()
        )


def read_jdbc(spark, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Read a JDBC table as a DataFrame."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {})).load()


class MemorySink:
    """Collects lazy results by name (tests, notebooks)."""

    def __init__(self):
        self.tables: dict[str, DataFrame] = {}

    def write(self, name: str, df: DataFrame) -> None:
        self.tables[name] = df
