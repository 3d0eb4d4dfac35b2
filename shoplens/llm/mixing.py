"""Mixing sources to target weights, cut where each source meets its budget.

Every document gets a hash-random key.  Within a source the documents are
dealt out by key range (keys are uniform, so equal ranges are even and need no
sampling pass), the sizes of the ranges are summed, the prefix sums over the
ranges give each range's place in the source's stream, and the range that
holds the cut is sorted and summed document by document.  A budget over the
source's size repeats the source as whole epochs before the cut.

A source with a third of all rows has as many more ranges; no task gets a
source whole.  The cut is one key per source, so applying the mix to the
documents needs no shuffle of texts.

Defined results
* the size of a document is its number of ``[^\\x20\\x09-\\x0D]+`` (null text: 0);
* sources by code point, null last, weigh 1, 2, 3, repeating; a target stops at
  three times its source's size and the excess is shared again by weight;
* the budget is the target rounded to whole words; documents are taken whole:
  the one that holds the cut is taken if that brings its source nearer to the
  budget, else left, so a source is off by half a document at most (rows with
  the same id and text count as one document there);
* documents without words take part with size 0: one stays for every whole
  epoch of its source, and for the last one if it comes before the cut; a source
  without any word keeps its documents once;
* null ids are allowed; an empty table gives an empty table; other columns are
  carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import materialise, sized, text_of

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
ROWS_PER_RANGE = 4096
_ORDER = ["u", "key", "id", "size"]


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more) -> DataFrame:
    """Narrow rows with a random key: ``u`` is its upper 31 bits, the place in the source."""
    text = text_of(text_col)
    key = F.xxhash64(F.col(id_col), text)
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("src"),
        n_words(text).alias("size"),
        F.shiftrightunsigned(key, 33).alias("u"),
        key.alias("key"),
        *more,
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of (src, rows, source_size), one row per source.

    Sources that would exceed their cap are those whose cap per weight lies
    below the common level; in order of that ratio they are a prefix, so one
    pass in that order finds them all.  The windows see one row per source.
    """
    by_name = Window.orderBy(F.col("src").asc_nulls_last())
    # every statement below sees all sources at once: one row each
    ranked = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * max_epochs)
    rise = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    everything = Window.partitionBy(F.lit(0))
    before = rise.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    ranked = ranked.withColumn(
        "full",
        (F.col("all_size") - F.col("cap_before")).cast("double") * F.col("weight")
        > F.col("cap").cast("double") * F.col("weight_left"),
    )
    # a cap can only be met while all smaller ratios are met
    ranked = ranked.withColumn("full", F.min(F.col("full")).over(rise.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn(
        "cap_full", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything)
    ).withColumn("weight_open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * (F.col("all_size") - F.col("cap_full")).cast("double") / F.col("weight_open")
    )
    return ranked.select("src", "rows", "source_size", "weight", target.alias("target"))


def plan_mix(keyed: DataFrame) -> DataFrame:
    """Per source: target, whole epochs, and the key and words of the cut."""
    sizes = keyed.groupBy("src").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    sources = source_targets(sizes)
    budget = F.floor(F.col("target") + 0.5).cast("long")
    sources = sources.withColumns(
        {
            "epochs": F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div source_size"))
            .otherwise(1)
            .cast("long"),
            "rest": F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0).cast("long"),
            "ranges": F.ceil(F.col("rows") / ROWS_PER_RANGE).cast("long"),
        }
    )
    sources = materialise(sources, "mix-sources")
    placed = keyed.alias("k").join(
        sized(sources.select(F.col("src").alias("s"), "ranges", "rest"), 64), F.col("src").eqNullSafe(F.col("s"))
    )
    placed = placed.withColumn("range", F.shiftright(F.col("u") * F.col("ranges"), 31)).drop("s")
    sums = placed.groupBy("src", "range", "rest").agg(F.sum("size").alias("range_size"))
    order = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("range_size").over(order), F.lit(0)))
    cut_range = sums.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("range_size")))
    cut_range = materialise(
        cut_range.select(F.col("src").alias("s"), F.col("range").alias("r"), "before"), "mix-cut-ranges"
    )
    # only the range with the cut is sorted: about ROWS_PER_RANGE rows per source
    inside = placed.join(
        sized(cut_range, 64), F.col("src").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))
    )
    ties = inside.groupBy("src", "rest", "before", *_ORDER).agg(F.count("*").alias("copies"))
    ties = ties.withColumn("words", F.col("size") * F.col("copies"))
    order = Window.partitionBy("src").orderBy(*[F.col(c).asc_nulls_first() for c in _ORDER])
    ties = ties.withColumn("end", F.col("before") + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    cut = ties.where((F.col("end") > F.col("rest")) & (F.col("end") - F.col("words") <= F.col("rest")))
    cut = cut.select(
        F.col("src").alias("c_src"),
        F.struct(*[F.col(c) for c in _ORDER]).alias("cut"),
        (2 * (F.col("rest") - (F.col("end") - F.col("words"))) >= F.col("words")).alias("cut_taken"),
    )
    plan = sources.join(cut, F.col("src").eqNullSafe(F.col("c_src")), "left").drop("c_src")
    return materialise(plan, "mix-plan")


def _taken(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with ``epochs`` copies, and whether a further one is taken (``more``)."""
    here = F.struct(*[F.col(c) for c in _ORDER])
    plan = plan.select(F.col("src").alias("p_src"), "source_size", "target", "epochs", "cut", "cut_taken")
    rows = keyed.join(sized(plan, 256), F.col("src").eqNullSafe(F.col("p_src")), "left")
    more = (here < F.col("cut")) | here.eqNullSafe(F.col("cut")) & F.col("cut_taken")
    return rows.withColumn("more", F.when(F.col("cut").isNull(), False).otherwise(F.coalesce(more, F.lit(False))))


def mixed_sizes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken."""
    keyed = materialise(_keyed(docs, id_col, text_col, source_col), "mix-keys")
    rows = _taken(keyed, plan_mix(keyed))
    return rows.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        ((F.col("epochs") + F.col("more").cast("long")) * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents: a row, whole, for each epoch that takes it."""
    keyed = materialise(_keyed(docs, id_col, text_col, source_col), "mix-keys")
    rows = _taken(_keyed(docs, id_col, text_col, source_col, F.struct("*").alias("row")), plan_mix(keyed))
    copies = (F.col("epochs") + F.col("more").cast("long")).cast("int")
    return rows.select("row", F.explode(F.array_repeat(F.lit(1), copies))).select("row.*")
