"""Helpers shared by the training-data operators.

* :func:`prepare` - session options every operator relies on;
* :func:`materialise` - cut the lineage with a written table in the shared
  checkpoint folder (columnar and compressed, so it is smaller than an RDD
  checkpoint and later reads prune columns);
* :func:`sized` - broadcast a table only behind a check of its size.
"""

from __future__ import annotations

import gc
import io
import os
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.sources.tables import load_table
from shoplens.spark import ensure_checkpoint_dir

#: A side of a join is broadcast up to this many bytes (rows x estimated width).
BROADCAST_BYTES = 32 << 20

#: Python operators work on slices of about this many text bytes.
SLICE_BYTES = 1 << 19

_shipped: weakref.WeakSet = weakref.WeakSet()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per context.

    The workers of a cluster need not have the repository on their path.
    """
    sc = spark.sparkContext
    if sc in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(top):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    target = os.path.join(tempfile.mkdtemp(prefix="shoplens-pkg-"), "shoplens.zip")
    with open(target, "wb") as f:
        f.write(blob.getvalue())
    sc.addPyFile(target)
    _shipped.add(sc)


def prepare(spark: SparkSession) -> None:
    """Adaptive plans, UTC and Arrow batches small in rows and in bytes (documents may be long)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")
    ship_package(spark)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return load_table(spark, sf_dir, name)


def text_of(text_col: str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the checkpoint folder that the whole cluster shares."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_scratch: list[list[str]] = []


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    if _scratch:
        _scratch[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialised inside are deleted at the end.

    What is needed later has to be written elsewhere by then; until then a
    lost executor finds everything it may have to read again.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours below the shared folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def sized(df: DataFrame, row_bytes: int, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its rows fit the limit, else unchanged.

    ``df`` is a materialised table, so counting it reads only file footers.
    Beyond the limit the planner shuffles both sides and AQE splits skewed
    partitions.
    """
    return F.broadcast(df) if fits(df, row_bytes, limit) else df


def fits(df: DataFrame, row_bytes: int, limit: int | None = None) -> bool:
    """Does a materialised table fit a broadcast?"""
    return df.count() * row_bytes <= (BROADCAST_BYTES if limit is None else limit)


def measured(df: DataFrame, row_bytes: Column, limit: int | None = None) -> DataFrame:
    """As :func:`sized`, for rows whose width varies: ``row_bytes`` is summed over the materialised table."""
    total = df.agg(F.sum(row_bytes.cast("long")).alias("b")).first().b or 0
    return F.broadcast(df) if total <= (BROADCAST_BYTES if limit is None else limit) else df


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive slices of about ``max_bytes`` of text (one row at least)."""
    if batch.num_rows == 0:
        return
    ends = np.cumsum(byte_lengths(batch.column(batch.schema.get_field_index(text))))
    lo = 0
    while lo < batch.num_rows:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def byte_lengths(col: pa.Array) -> np.ndarray:
    offsets, _ = utf8_buffers(col)
    return np.diff(offsets)


def utf8_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a string column without nulls."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    _, off, data = col.buffers()
    if n == 0 or off is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


_held: dict = {}


def worker_state(key, build):
    """What a worker process keeps between tasks: the state of one operator at a time."""
    if key not in _held:
        release_state()
        _held[key] = build()
    return _held[key]


def release_state() -> None:
    """Operators without state free what an earlier one left in a reused worker."""
    if _held:
        _held.clear()
        gc.collect()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
