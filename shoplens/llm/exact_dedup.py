"""Exact deduplication by progressive refinement (DataFrame operations only).

1. One scan keeps a narrow row per document: byte length and the hash of a
   short prefix.  Lengths that occur once are settled.
2. Among the rest, pairs (length, prefix hash) that occur once are settled.
3. Only documents of surviving groups have their full content hashed
   (SHA-256) and grouped by it.  While the surviving keys fit a broadcast of
   checked size, they pick these documents where they are read; beyond it every
   text is hashed there instead, and narrow rows meet the keys in a shuffle.
   No text enters a shuffle to find or to report groups.

Groups are pre-aggregated before every shuffle, so a group that holds a third
of all rows sends one row per task.

Defined results
* null text counts as empty; empty texts are equal to each other;
* of equal texts the row with the largest id stays; a null id is smaller than
  any id; if all ids of a group are null, one of its rows stays;
* a row that occurs again with the same id and text counts in ``group_size``,
  and :func:`drop_duplicates` keeps one of the repeats;
* an empty table gives an empty table; other columns are carried through
  untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import fits, materialise, sized, text_of

PREFIX_CHARS = 64


def _narrow(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix_hash"),
        *more,
    )


def surviving_prefixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Steps 1 and 2: (n_bytes, prefix_hash) of the groups that may hold equal texts."""
    narrow = materialise(_narrow(docs, id_col, text_col).select("n_bytes", "prefix_hash"), "dedup-narrow")
    lengths = materialise(narrow.groupBy("n_bytes").count().where("count > 1").select("n_bytes"), "dedup-lengths")
    by_prefix = narrow.join(sized(lengths, 16), "n_bytes", "left_semi").groupBy("n_bytes", "prefix_hash").count()
    return materialise(by_prefix.where("count > 1").select("n_bytes", "prefix_hash"), "dedup-prefixes")


def _hashed(rows: DataFrame, prefixes: DataFrame, how: str, *more: str) -> DataFrame:
    """(id, n_bytes, prefix_hash, full_hash, more...) of documents of surviving groups (``left``: of all documents)."""
    columns = ["id", "n_bytes", "prefix_hash", *more]
    full = F.sha2("text", 256)
    if not fits(prefixes, 32):
        # the hash is taken before the shuffle, so that the text stays behind
        rows = rows.select(*columns, full.alias("full_hash"))
        return rows if how == "left" else rows.join(prefixes, ["n_bytes", "prefix_hash"], how)
    if how == "left":
        rows = rows.join(F.broadcast(prefixes.withColumn("survives", F.lit(True))), ["n_bytes", "prefix_hash"], how)
        full = F.when(F.col("survives"), full)
    else:
        rows = rows.join(F.broadcast(prefixes), ["n_bytes", "prefix_hash"], how)
    return rows.select(*columns, full.alias("full_hash"))


def duplicate_groups(
    docs: DataFrame, prefixes: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Step 3: one row per group of at least two equal texts.

    ``repeats``: how many of the group's rows carry ``keep_id``.
    """
    hashed = _hashed(_narrow(docs, id_col, text_col), prefixes, "left_semi")
    key = ["n_bytes", "prefix_hash", "full_hash"]
    groups = (
        hashed.groupBy(*key, "id")
        .agg(F.count("*").alias("copies"))
        .groupBy(*key)
        .agg(
            F.max("id").alias("keep_id"),
            F.sum("copies").alias("group_size"),
            F.coalesce(F.max_by("copies", "id"), F.sum("copies")).alias("repeats"),
        )
        .where("group_size > 1")
    )
    return materialise(groups, "dedup-groups")


def _with_groups(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Every one of ``rows`` with its group, if it has one; no row is lost or multiplied."""
    prefixes = surviving_prefixes(docs, id_col, text_col)
    groups = duplicate_groups(docs, prefixes, id_col, text_col)
    rows = _hashed(rows, prefixes, "left", *more)
    return rows.join(sized(groups, 160), ["n_bytes", "prefix_hash", "full_hash"], "left")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    The digest of the documents that were settled early is taken only because
    the report asks for it; no decision uses it.
    """
    narrow = _narrow(docs, id_col, text_col).withColumn("text_sha256", F.sha2("text", 256))
    rows = _with_groups(docs, narrow, id_col, text_col, "text_sha256")
    grouped = F.col("group_size").isNotNull()
    return rows.select(
        F.col("id").alias(id_col),
        F.when(grouped, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (~grouped | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text a row with a larger id also has.

    While the groups fit a broadcast no whole row is shuffled; beyond it each
    is, once.
    """
    rows = _with_groups(docs, _narrow(docs, id_col, text_col, F.struct("*").alias("row")), id_col, text_col, "row")
    grouped = F.col("group_size").isNotNull()
    kept = rows.where(~grouped | F.col("id").eqNullSafe(F.col("keep_id")))
    single = kept.where(~grouped | (F.col("repeats") == 1)).select("row.*")
    # an id that occurs again with the same text: rare, so only these rows are shuffled
    again = kept.where(grouped & (F.col("repeats") > 1)).dropDuplicates(["id", "n_bytes", "prefix_hash", "full_hash"])
    return single.unionByName(again.select("row.*"))
