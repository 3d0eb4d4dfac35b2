"""Expose DataFrames as temporary views for Spark SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """``createOrReplaceTempView`` for each (name, frame); returns the names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)
