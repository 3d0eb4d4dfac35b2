"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space collapsed and trimmed) and
hashed.  For every host the distinct documents that contain a line are counted;
copies of a text count as one document.  Lines in more documents than the limit
are removed, and a document of which too little is left is rejected.  The
limit is a number of documents, so a line has the same verdict whatever else its
host holds; small groups of related documents are left alone.

One scan measures the documents and hashes their lines; everything after it
works on that narrow table.  A document contributes each of its lines once,
distinct rows are spread by (host, line, text) and pre-aggregated before they
meet by line, so neither a host with a third of all rows nor a line in every
document lands in one task.

Defined results: null text counts as empty; a null host is a host of its own;
lines without words are no lines; documents without words fail the base rule;
null and repeated ids each give their own row; an empty table gives an empty
table; other columns are ignored, or carried through by
:func:`remove_frequent_lines`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from shoplens.llm.common import column, materialise, measured, sized, slices, text_of, utf8_buffers
from shoplens.llm.words import NON_SPACE, Words, mix, windows

#: A line is frequent in more documents of its host than this.
MIN_DOCUMENTS = 5
#: A document is depleted below this share of its words, or below this many words.
MIN_LEFT_SHARE = 0.3
MIN_LEFT_WORDS = 10
MIN_WORDS = 10
SLICE = 1 << 18
MAX_REPEATED_PERCENT = 20
WINDOW = 5

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
#: Every byte but the second and later ones of a character.
_CHARACTER = (np.arange(256) & 0xC0) != 0x80


def line_table(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines that have words: hash of the normalised line, its words, pointer per document.

    ``words`` are lower-cased; a line is the sequence of its words.
    """
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(words.ptr), np.int64)
    breaks = np.searchsorted(np.flatnonzero(words.data == 0x0A), words.starts)
    begins = np.ones(len(words), bool)
    begins[1:] = breaks[1:] != breaks[:-1]
    begins[words.ptr[:-1][words.counts > 0]] = True
    first = np.flatnonzero(begins)
    lengths = np.diff(np.append(first, len(words)))
    place = np.arange(len(words)) - np.repeat(first, lengths)
    # each word is mixed with its place before the sum, so no pattern of words cancels out
    hashes = np.add.reduceat(mix(words.hashes() ^ mix(place.astype(np.uint64))), first)
    return mix(hashes + lengths.astype(np.uint64)), lengths, np.searchsorted(first, words.ptr)


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(words: Words) -> np.ndarray:
    """Words of each document within a window that occurs there twice or more."""
    found, ptr = windows(words.hashes(), words.ptr, WINDOW)
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    own = mix(found ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    _, inverse, n = np.unique(own, return_inverse=True, return_counts=True)
    again = np.flatnonzero(n[inverse] > 1)
    first = again - ptr[doc[again]] + words.ptr[doc[again]]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + WINDOW, -1)
    return _per_document(np.cumsum(edge[:-1]) > 0, words.ptr)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            texts = column(part, "text")
            offsets, data = utf8_buffers(texts)
            words = Words(offsets, data, NON_SPACE, lower=False)
            line, line_words, ptr = line_table(Words(offsets, data, NON_SPACE, lower=True))
            rows = pa.StructArray.from_arrays([pa.array(line.view(np.int64)), pa.array(line_words, pa.int32())], ["line", "words"])
            repeated = []
            for t in texts.cast(pa.large_binary()):
                lines = [x for x in t.as_py().split(b"\n") if x.strip()]
                repeated.append(len(lines) - len(set(lines)))
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(part, c) for c in ("id", "host", "print")),
                    pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), rows),
                    pa.array(words.counts, pa.int64()),
                    pa.array(_per_document(NON_SPACE[data] & _CHARACTER[data], offsets), pa.int64()),
                    pa.array(_per_document(_SYMBOL[data], offsets), pa.int64()),
                    pa.array(repeated, pa.int64()),
                    pa.array(_repeated_words(words), pa.int64()),
                ],
                ["id", "host", "print", "lines", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
            )


def measure(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """The narrow table of one scan; ``row`` tells its rows apart from now on."""
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        _host(host_col).alias("host"),
        F.xxhash64(text).alias("print"),
        text.alias("text"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(
        _measure,
        f"id {kind}, host string, print long, lines array<struct<line long, words int>>, n_words long, word_chars long, "
        "n_symbols long, n_dup_lines long, n_repeat_words long",
    )
    return materialise(found.withColumn("row", F.monotonically_increasing_id()), "line-measures")


def _host(host_col: str) -> Column:
    """A null host as the empty string, every other one with a mark before it."""
    return F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit(""))


def _host_bytes() -> Column:
    """Bytes of a narrow row with a host."""
    return F.octet_length("host") + 32


def _distinct_lines(measures: DataFrame) -> DataFrame:
    """(host, print, line), each once."""
    lines = measures.select("host", "print", F.explode(F.array_distinct(F.transform("lines", lambda x: x.line))).alias("line"))
    return lines.distinct()


def frequent_lines(measures: DataFrame, min_documents: int = MIN_DOCUMENTS, max_share: float | None = None) -> DataFrame:
    """(host, line) above the limit; ``max_share`` also asks for more than this share of the host's documents."""
    lines = _distinct_lines(measures)
    above = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > min_documents)
    if max_share is not None:
        contents = measures.select("host", "print").distinct().groupBy("host").agg(F.count("*").alias("documents"))
        contents = materialise(contents, "line-hosts")
        above = above.join(measured(contents, _host_bytes()), "host").where(F.col("n") > max_share * F.col("documents"))
    return materialise(above.select("host", "line"), "line-frequent")


def line_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_share: float | None = None,
) -> DataFrame:
    """One row per document: id, measures, base_failed, kept, words_left."""
    measures = measure(docs, id_col, text_col, host_col)
    frequent = frequent_lines(measures, min_documents, max_share)
    lines = measures.select("row", "host", F.inline("lines"))
    removed = lines.join(measured(frequent, _host_bytes()), ["host", "line"], "left_semi").groupBy("row").agg(F.sum("words").alias("removed"))
    rows = measures.drop("lines").join(sized(materialise(removed, "line-removed"), 32), "row", "left")
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    depleted = (left < MIN_LEFT_WORDS) | (left < MIN_LEFT_SHARE * F.col("n_words"))
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        left.alias("words_left"),
    )


def remove_frequent_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_share: float | None = None,
) -> DataFrame:
    """``docs`` without frequent lines; depleted documents are dropped.

    A host's frequent lines grow with the host, so every text meets only its own.
    """
    rows_of = measure(docs, id_col, text_col, host_col)
    frequent = frequent_lines(rows_of, min_documents, max_share)
    found = _distinct_lines(rows_of).join(measured(frequent, _host_bytes()), ["host", "line"], "left_semi")
    by_text = found.groupBy(F.col("host").alias("f_host"), F.col("print").alias("f_print")).agg(F.collect_set("line").alias("bad"))
    by_text = materialise(by_text, "line-lists")
    text = text_of(text_col)
    rows = docs.select(F.struct("*").alias("row"), text.alias("text"), _host(host_col).alias("host"), F.xxhash64(text).alias("print"))
    own = (F.col("host") == F.col("f_host")) & (F.col("print") == F.col("f_print"))
    lists = measured(by_text, F.octet_length("f_host") + 8 * F.size("bad") + 32)
    rows = rows.join(lists, own, "left").select("row", "text", "bad")
    schema = StructType(
        [StructField("row", docs.select(F.struct("*").alias("row")).schema["row"].dataType), StructField("clean", StringType()), StructField("depleted", BooleanType())]
    )
    rows = rows.mapInArrow(_clean, schema).where("not depleted")
    return rows.select(*[F.col("clean").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            texts = column(part, "text")
            words = Words(*utf8_buffers(texts), NON_SPACE, lower=True)
            line, line_words, ptr = line_table(words)
            clean, depleted = [], []
            for d, (text, bad) in enumerate(zip(texts.cast(pa.large_binary()), column(part, "bad"))):
                own = slice(ptr[d], ptr[d + 1])
                drop = np.isin(line[own].view(np.int64), bad.as_py() or [])
                left, total = int(line_words[own][~drop].sum()), int(words.counts[d])
                flags = iter(drop.tolist())
                kept = [x for x in text.as_py().split(b"\n") if not (x.strip() and next(flags))]
                clean.append(b"\n".join(kept).decode("utf-8"))
                depleted.append(left < MIN_LEFT_WORDS or left < MIN_LEFT_SHARE * total)
            yield pa.RecordBatch.from_arrays(
                [column(part, "row"), pa.array(clean, pa.string()), pa.array(depleted, pa.bool_())], ["row", "clean", "depleted"]
            )
