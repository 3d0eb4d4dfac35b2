"""Plain parquet folders that micro-batches and re-runs can write to safely.

Three layouts, each an ordinary partitioned folder that any reader can open:

* :class:`BatchFolder` - one partition per (streaming query, micro-batch).  A
  replayed batch replaces its own partition and nothing else, so what a batch
  writes counts once; the work of a batch does not depend on what is stored.
* :func:`overwrite_partitions` - rows replace the partitions they belong to
  (dynamic partition overwrite), e.g. the top-3 of the touched (date, province).
* :func:`upsert_partitions` - rows replace stored rows with the same key inside
  the partitions they touch.

Everything goes through Spark's reader and writer, so a folder may be on any
file system the cluster mounts (HDFS, object stores).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shoplens.spark import ensure_checkpoint_dir


def _fs_path(spark: SparkSession, path: str):
    """Hadoop path and its file system: works on any cluster file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs_path(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs_path(spark, path)
    fs.mkdirs(p)


def _children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_folder(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a partitioned folder; a folder that is not there yet has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def overwrite_partitions(rows: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Write ``rows`` in place of the partitions they belong to; others stay.  Idempotent."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_cols).parquet(path)


def upsert_partitions(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partition_col: str) -> None:
    """Overwrite-by-key into a parquet table partitioned by ``partition_col``.

    Only the partitions that ``new`` touches are read, merged and rewritten
    (dynamic partition overwrite).  The merged rows are first materialised in
    the shared checkpoint folder, so the rewrite never reads the files it is
    replacing.  Idempotent: replaying the same rows gives the same table.
    Only a missing folder counts as "no table yet"; stored rows that do not
    fit ``new`` raise.
    """
    touched = [r[0] for r in new.select(partition_col).distinct().collect()]
    merged = new
    if exists(spark, path):
        old = spark.read.parquet(path).where(F.col(partition_col).isin(touched))
        merged = old.join(new.select(*keys), keys, "left_anti").unionByName(new)
    # always a real checkpoint here: the rewrite must not read its own target
    ensure_checkpoint_dir(spark)
    merged = merged.checkpoint(eager=True)
    overwrite_partitions(merged, path, [partition_col])


#: Up to so many partition values are named in the scan's filter; beyond, the join prunes partitions itself.
NAMED_PARTITIONS = 1000


def stored_rows(stored: DataFrame, keys: DataFrame, on: list[str], partition_col: str) -> DataFrame:
    """The stored rows of ``keys``, read from the partitions of those keys alone.

    One semi join instead of a query per key.
    """
    keys = keys.select(*on).distinct()
    values = [r[0] for r in keys.select(partition_col).distinct().limit(NAMED_PARTITIONS + 1).collect()]
    if len(values) <= NAMED_PARTITIONS:
        stored = stored.where(F.col(partition_col).isin([v for v in values if v is not None]))
    return stored.join(keys, on, "left_semi")


class BatchFolder:
    """Rows of micro-batches under ``<path>/query=<id>/batch=<n>[/<partition_col>=...]``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition_col: str | None = None):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col
        # where a row was written: the last columns
        self.schema = StructType([*schema.fields, StructField("query", StringType()), StructField("batch", LongType())])

    def _part(self, query: str, batch: int) -> str:
        return f"{self.path}/query={query}/batch={batch}"

    def has(self, query: str, batch: int) -> bool:
        return exists(self.spark, self._part(query, batch))

    def complete(self, query: str, batch: int) -> bool:
        """Has this batch been written to the end before?"""
        return exists(self.spark, f"{self._part(query, batch)}/_SUCCESS")

    def queries(self) -> list[str]:
        """Streaming queries that have written here."""
        return [n.split("=", 1)[1] for n in _children(self.spark, self.path) if n.startswith("query=")]

    def write(self, rows: DataFrame, query: str, batch: int) -> None:
        """The rows of one batch, in place of what an earlier try of the same batch has left."""
        writer = rows.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "static")
        if self.partition_col:
            writer = writer.partitionBy(self.partition_col)
        writer.parquet(self._part(query, batch))

    def read(self, values: list | None = None) -> DataFrame:
        """All rows with ``query`` and ``batch``; with ``values`` only those partitions are listed and read."""
        rows = read_folder(self.spark, self.path, self.schema)
        return rows if values is None else rows.where(F.col(self.partition_col).isin(values))

    def batch(self, query: str, batch: int) -> DataFrame:
        return self.read().where((F.col("query") == query) & (F.col("batch") == batch))
