"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on.  AQE re-plans joins and partition counts at
# runtime from real shuffle statistics; skew-join splitting handles a hot
# session/user/category that holds a large share of the rows.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "shoplens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied.

    ``master`` is left to ``spark-submit`` when None.  On a cluster pass
    nothing and configure through ``--conf``; locally pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate() may hand back an existing session: the runtime-settable
    # SQL options are re-applied so every job sees the same semantics.
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder, setting ``fallback`` only when unset.

    Clusters name a shared folder in ``spark.checkpoint.dir``; that always
    wins.  The fallback is for local runs and tests.
    """
    current = checkpoint_dir(spark)
    if current:
        return current
    if fallback is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        fallback = tempfile.mkdtemp(prefix="shoplens-ckpt-")
    if "://" not in fallback:
        os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder.

    Used where one intermediate feeds several outputs: a lost executor then
    re-reads the checkpoint instead of recomputing the whole lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Most rows of a side that is broadcast because its number of rows is known.
BROADCAST_ROWS = 100_000


def broadcast_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has ``rows`` rows at most, broadcast if that is few; beyond it the planner decides."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
