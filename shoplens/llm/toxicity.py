"""Toxicity by class-conditional Kneser-Ney models.

Expressions are the steps by which a word is spelled out: its first bytes,
more of its first bytes, the whole word.  Each step is predicted from the one
before it, so a word that was never seen still shows the stem it shares with
words that were.  For class c, step u and the step h before it

    P_c(u | h) = (N_c(u) - D(u) * (N_c(u) - N(u) * S_c(h))) / N_c(h)

where N counts documents that contain a step (Kneser-Ney counts in how many
contexts something occurs; the context here is the document), of one class or
of both.  S_c(h), the smoothed share of class c among the documents with h, is
what the numerator of the step before is of N(h).  D is the discount: what it
takes from a class's count goes back to both classes through the shared count
N(u), in proportion to S_c(h).  As in modified Kneser-Ney the discount depends
on the count: D = K / (K + z^2), with z the number of standard deviations by
which N_c(u) differs from N(u) * S_c(h).  A rare expression keeps a small part
of its count, a frequent one that both classes hold alike nearly none, one
that only toxic documents hold, often, nearly all; no step is left out for
being rare.

The difference of the log-likelihoods is a sum over steps, divided by the
number of words.  The sum is kept in parts, by z^2 and by sign, because rare
expressions (small z) deserve a belief of their own: a logistic curve over the
parts turns them into the score.  It is fitted on the labelled documents
themselves, each by counts that leave this document out.

Counts cover all labelled training rows and grow with them.  The model is a
table (step, weight); it is broadcast up to a bounded number of steps, beyond it
the documents' distinct steps meet it in a shuffled join.

Defined results: null text counts as empty; a document without words gets the
score of a difference of 0; null labels and labels without document are
ignored, a document labelled repeatedly has its largest label; without
labelled rows of both classes the score is the smoothed share of label 1,
(n1 + 1) / (n + 2); repeated rows and null ids each give a row; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import column, materialise, sized, slices, text_of, utf8_buffers
from shoplens.llm.words import ALNUM, Words, mix

STEMS = (4, 6)
#: K: a count so many squared deviations from the shared one keeps half of the difference.
DISCOUNT = 60.0
#: Shares are kept this far from 0 and 1.
LEAST_SHARE = 1e-3
#: Weights below this say nothing: a thousand of them weigh less than one expression.
LEAST_WEIGHT = 1e-3
#: Added to the number of words: a single word is weak evidence.
SMALL = 5
#: Bounds of z^2 between the parts of a difference, for either sign.
BANDS = (1.0, 4.0, 16.0, 64.0)
PARTS = 2 * (len(BANDS) + 1)
#: Weights are broadcast up to so many steps, of 23 bytes each.
BLOCK_STEPS = 2_000_000
FLUSH_STEPS = 1_500_000
#: Rows of a batch of documents' steps.
STEP_ROWS = 20_000
THRESHOLD = 0.3
#: Which weight applies: counts without one ordinary document, without one toxic document, all counts.
WITHOUT_ORDINARY, WITHOUT_TOXIC, ALL = range(3)
WEIGHTS = ("without_ordinary", "without_toxic", "weight")
IN_PART = tuple(f"part_{c}" for c in WEIGHTS)
_TAGS = [np.uint64(0x51ED270B3F4A9C2D), np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)]


def steps(words: Words) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: (which words have it, step, step before it)."""
    whole = mix(words.hashes() ^ _TAGS[-1])
    lengths = words.ends - words.starts
    out = []
    own = np.arange(len(words))
    before = np.zeros(len(words), np.uint64)
    for level, size in enumerate(STEMS):
        stem = mix(words.prefix_hashes(size) ^ _TAGS[level])
        step = np.where(lengths > size, stem, whole)
        out.append((own, step[own], before[own]))
        own = own[lengths[own] > size]
        before = step
    out.append((own, whole[own], before[own]))
    return out


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Counts summed by step."""
    step, before, toxic, n = (np.concatenate(x) for x in zip(*parts))
    kinds, first, inverse = np.unique(step, return_index=True, return_inverse=True)
    return (
        kinds,
        before[first],
        np.bincount(inverse, toxic, len(kinds)).astype(np.int64),
        np.bincount(inverse, n, len(kinds)).astype(np.int64),
    )


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(step, before, toxic, n): documents that contain each step, pre-aggregated by task."""

    def batch_of(merged: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        step, before, toxic, n = merged
        return pa.RecordBatch.from_arrays(
            [_signed(step), _signed(before), pa.array(toxic), pa.array(n)], ["step", "before", "toxic", "n"]
        )

    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(*utf8_buffers(column(part, "text")), ALNUM, lower=True)
            label = column(part, "label").to_numpy().astype(np.int64)
            docs = words.docs()
            for own, step, before in steps(words):
                # once per document: pairs told apart by a mixed hash
                doc = docs[own]
                _, first = np.unique(mix(step ^ mix(doc.astype(np.uint64) + np.uint64(1))), return_index=True)
                toxic = label[doc[first]]
                held.append(_merged([(step[first], before[first], toxic, np.ones(len(first), np.int64))]))
                size += len(held[-1][0])
        if size > FLUSH_STEPS:
            held = [_merged(held)]
            size = len(held[0][0])
            if size > FLUSH_STEPS // 2:
                yield batch_of(held[0])
                held, size = [], 0
    if held:
        yield batch_of(_merged(held))


def _squares(toxic: Column, n: Column, before: Column) -> Column:
    off = toxic - n * before
    return off * off / (n * before * (1 - before) + 1)


def _smoothed(toxic: Column, n: Column, before: Column) -> Column:
    """Smoothed toxic share of a step, from that of the step before it."""
    squares = _squares(toxic, n, before)
    share = before + squares / (squares + DISCOUNT) * (toxic / n - before)
    return F.when(n > 0, F.least(F.greatest(share, F.lit(LEAST_SHARE)), F.lit(1 - LEAST_SHARE))).otherwise(before)


def _part(toxic: Column, n: Column, before: Column) -> Column:
    """The part of a difference that a step belongs to."""
    band = sum((F.when(_squares(toxic, n, before) > b, 1).otherwise(0) for b in BANDS), F.lit(0))
    return F.when(toxic < n * before, band + PARTS // 2).otherwise(band).cast("int")


def step_weights(counts: DataFrame, base: float) -> DataFrame:
    """(step, weights, parts): log P_toxic - log P_ordinary less that of the step before, by :data:`WEIGHTS`.

    ``counts``: (step, before, toxic, n); ``base``: the toxic share of all rows.
    """
    left_out = ((F.col("toxic"), F.col("n") - 1), (F.col("toxic") - 1, F.col("n") - 1), (F.col("toxic"), F.col("n")))

    def shares(rows: DataFrame, before: list[Column]) -> DataFrame:
        own = [
            # a document can be left out only of a count that holds it
            F.when((t >= 0) & (n - t >= 0), _smoothed(t, n, b)).otherwise(b)
            for (t, n), b in zip(left_out, before)
        ]
        log_odds = [F.log(o / (1 - o)) - F.log(b / (1 - b)) for o, b in zip(own, before)]
        parts = [_part(t, n, b) for (t, n), b in zip(left_out, before)]
        return rows.select(
            "step", *[o.alias(f"s{i}") for i, o in enumerate(own)], *[w.alias(c) for w, c in zip(log_odds, WEIGHTS)],
            *[x.alias(c) for x, c in zip(parts, IN_PART)],
        )

    counts = materialise(counts, "toxicity-counts")
    level = shares(counts.where(F.col("before") == 0), [F.lit(base)] * 3)
    found = []
    for depth in range(len(STEMS) + 1):
        level = materialise(level, "toxicity-shares")
        found.append(level.select("step", *WEIGHTS, *IN_PART))
        if depth < len(STEMS):
            parents = level.select(F.col("step").alias("h"), *[F.col(f"s{i}").alias(f"b{i}") for i in range(3)])
            rows = counts.join(parents, F.col("before") == F.col("h"))
            level = shares(rows, [F.col(f"b{i}") for i in range(3)])
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    weighty = F.greatest(*[F.abs(c) for c in WEIGHTS]) >= LEAST_WEIGHT
    narrow = [*[F.col(c).cast("float").alias(c) for c in WEIGHTS], *[F.col(c).cast("tinyint").alias(c) for c in IN_PART]]
    return materialise(out.where(weighty).select("step", *narrow), "toxicity-weights")


def _table(weights: DataFrame, block_steps: int) -> Broadcast | None:
    """The weights as sorted arrays, if they are few enough to broadcast."""
    if weights.count() > block_steps:
        return None
    own = weights.toArrow()
    keys = own["step"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    values = np.stack([own[c].to_numpy()[order] for c in WEIGHTS]).astype(np.float32)
    parts = np.stack([own[c].to_numpy()[order] for c in IN_PART]).astype(np.int8)
    return weights.sparkSession.sparkContext.broadcast((keys[order], values, parts))


def _differences(rows: DataFrame, weights: DataFrame, table: Broadcast | None) -> DataFrame:
    """``rows`` (id, print, text, extra) -> (id, extra, n_words, parts): the parts of each row's difference.

    ``extra`` says which of the weights count.
    """
    if table is None:
        return _joined_differences(rows, weights)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, in_part = table.value
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(*utf8_buffers(column(part, "text")), ALNUM, lower=True)
                # every word of a slice is looked up once
                _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
                docs = words.docs()
                kinds = column(part, "extra").to_numpy()[docs]
                out = np.zeros(part.num_rows * PARTS)
                for own, step, _ in steps(words.only(first)):
                    at = np.searchsorted(keys, step)
                    at[at == len(keys)] = 0
                    hit = np.flatnonzero(keys[at] == step) if len(keys) else np.zeros(0, np.int64)
                    # of each distinct word its place in the table at this level, or none
                    place = np.full(len(first), -1)
                    place[own[hit]] = at[hit]
                    place = place[which]
                    known = np.flatnonzero(place >= 0)
                    entry = kinds[known], place[known]
                    out += np.bincount(docs[known] * PARTS + in_part[entry], values[entry], len(out))
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "id"),
                        column(part, "extra"),
                        pa.array(words.counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * PARTS, pa.int32()), pa.array(out, pa.float64())),
                    ],
                    ["id", "extra", "n_words", "parts"],
                )

    return rows.mapInArrow(run, f"id {kind}, extra int, n_words long, parts array<double>")


def _document_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(document, step, times) of each document's distinct steps, and one row of 0 times that stands for the document."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(*utf8_buffers(column(part, "text")), ALNUM, lower=True)
            docs = words.docs()
            prints = column(part, "print").to_numpy().view(np.uint64)
            held = [(np.arange(part.num_rows), mix(prints), np.zeros(part.num_rows, np.int64))]
            for own, step, _ in steps(words):
                order = np.lexsort((step, docs[own]))
                doc, step = docs[own][order], step[order]
                first = np.ones(len(step), bool)
                first[1:] = (doc[1:] != doc[:-1]) | (step[1:] != step[:-1])
                at = np.flatnonzero(first)
                held.append((doc[at], step[at], np.diff(np.append(at, len(step)))))
            doc, step, times = (np.concatenate(x) for x in zip(*held))
            of = pa.array(doc)
            for lo in range(0, len(doc), STEP_ROWS):
                cut = slice(lo, lo + STEP_ROWS)
                own = of[cut]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column(part, c).take(own) for c in ("id", "print", "extra")),
                        pa.array(words.counts[doc[cut]], pa.int64()),
                        _signed(step[cut]),
                        pa.array(times[cut], pa.int64()),
                    ],
                    ["id", "print", "extra", "n_words", "step", "times"],
                )


def _joined_differences(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """The same by a shuffled join on the step; one pass over the texts, nothing at the driver."""
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_document_steps, f"id {kind}, print long, extra int, n_words long, step long, times long")
    found = found.join(weights.hint("merge"), "step", "left")
    # a row that occurs again has its twin's sum: they are summed together and parted by their number
    own = F.element_at(F.array(*WEIGHTS), F.col("extra") + 1).cast("double")
    of = F.element_at(F.array(*IN_PART), F.col("extra") + 1)
    sums = [F.sum(F.when(of == i, F.col("times") * own).otherwise(0.0)) for i in range(PARTS)]
    copies = F.count_if(F.col("times") == 0).cast("int")
    summed = found.groupBy("id", "print", "extra", "n_words").agg(F.array(*sums).alias("sums"), copies.alias("copies"))
    return summed.select(
        "id", "extra", "n_words", F.transform("sums", lambda x: x / F.col("copies")).alias("parts"), F.explode(F.sequence(F.lit(1), "copies")).alias("c")
    ).drop("c")


def _normalised() -> list[Column]:
    return [F.col("parts")[i] / (F.col("n_words") + SMALL) for i in range(PARTS)]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    parts: int = 4,
    held_out: int = 2,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """One row per document: id, held_out, score, predicted.  Rows held out never train."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))
    out = F.coalesce(F.crc32(F.col("id").cast("string")) % parts == held_out, F.lit(False))
    own = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    own = own.groupBy(F.col(id_col).alias("l_id")).agg(F.max(label).cast("int").alias("label"))
    own = own.where(F.crc32(F.col("l_id").cast("string")) % parts != held_out)
    known = rows.join(sized(materialise(own, "toxicity-labels"), 16), F.col("id") == F.col("l_id")).drop("l_id")
    classes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    n1, n0 = classes.get(1, 0), classes.get(0, 0)
    base = (n1 + 1) / (n1 + n0 + 2)

    counts = known.select("text", "label").mapInArrow(_counts, "step long, before long, toxic long, n long")
    counts = counts.groupBy("step").agg(F.any_value("before").alias("before"), F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    weights = step_weights(counts, base)

    table = _table(weights, block_steps)
    slopes, level = [0.0] * PARTS, math.log(base / (1 - base))
    if n1 and n0:
        fitting = known.select("id", "print", "text", F.col("label").alias("extra"))
        fitting = materialise(_differences(fitting, weights, table), "toxicity-curve")
        vectors = fitting.select(F.col("extra").alias("label"), array_to_vector(F.array(*_normalised())).alias("features"))
        fitted = LogisticRegression(regParam=1e-3, maxIter=100, standardization=True).fit(vectors)
        slopes, level = fitted.coefficients.toArray().tolist(), float(fitted.intercept)
    scored = _differences(rows.withColumn("extra", F.lit(ALL)), weights, table)
    total = sum((F.lit(a) * x for a, x in zip(slopes, _normalised())), F.lit(level))
    score = 1 / (1 + F.exp(-total))
    scored = scored.select("id", out.alias("held_out"), score.alias("score"))
    return scored.select(
        F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
