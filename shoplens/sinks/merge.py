"""Merge operations of the reference's MySQL DAOs, as DataFrame algebra.

Each takes the current table and the incoming rows and returns the new
table; writing it is the job of :mod:`shoplens.sinks.folders`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_overwrite(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def merge_add(old: DataFrame, delta: DataFrame, keys: list[str], value: str) -> DataFrame:
    """K9: add ``delta``'s ``value`` to the stored one (insert when new).

    Not idempotent by itself: a streaming batch stores its rows under its own
    batch id instead (:class:`shoplens.sinks.folders.BatchFolder`).
    """
    return (
        old.unionByName(delta.select(*keys, value))
        .groupBy(*keys)
        .agg(F.sum(value).cast("bigint").alias(value))
    )


def replace_groups(old: DataFrame, new: DataFrame, group_keys: list[str]) -> DataFrame:
    """Every group present in ``new`` is replaced whole (delete + insert)."""
    return old.join(new.select(*group_keys).distinct(), group_keys, "left_anti").unionByName(new)


def append_new(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Add the rows of ``new`` whose key is not stored yet (no duplicates, Q15)."""
    fresh = new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh)
