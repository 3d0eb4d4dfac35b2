"""Token counts by a map-side two-tier lookup.

Tier 1 is a compact hash table, unit hash -> number of tokens, of frequent
units; it has a fixed number of entries and is broadcast.  Tier 2 is a cache in each worker process: units that miss the
table are encoded by the library once and remembered, up to a fixed number of
entries.  Documents are counted where they are read, a slice at a time with
array operations; no document's units are shuffled.

The table's units are those of a sample of about ``SAMPLE_ROWS`` documents,
chosen at random over the whole table: their texts go to a few tasks, each keeps
a bounded summary of its frequent units, and the summaries' top entries are
merged.  No unit is shuffled there either.  The table decides speed alone:
counts come out the same with any table.

Defined results: null text counts as empty (0 bytes, 0 tokens); null and
repeated ids each give their own row; a unit of any length is counted whole;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import column, slices, text_of, utf8_buffers, worker_state
from shoplens.llm.piece_table import PieceTable
from shoplens.llm.tokenizing import LibraryEncoder, Units, broadcast_tokenizer, tokenizer_json

TABLE_ENTRIES = 65_536
SLOTS = 1 << 18
#: Documents, and tasks, from which the table's units are taken.
SAMPLE_ROWS, SAMPLE_TASKS = 20_000, 8
SUMMARY_ENTRIES = 100_000
SUMMARY_SENT = 8_192
CACHE_ENTRIES = 1_500_000
LONGEST_IN_TABLE = 48
TOKEN_LIMIT = 2048
SLICE = 4 << 20


def _units(part: pa.RecordBatch) -> Units:
    return Units(*utf8_buffers(column(part, "text")))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def top(n: int) -> list[tuple[bytes, int]]:
        return heapq.nlargest(n, counts.items(), key=lambda x: (x[1], x[0]))

    for batch in batches:
        for part in slices(batch, "text", SLICE):
            units = _units(part)
            _, first, n = np.unique(units.hashes(), return_index=True, return_counts=True)
            often = np.argsort(-n, kind="stable")[:SUMMARY_SENT]
            often = often[(units.ends - units.starts)[first[often]] <= LONGEST_IN_TABLE]
            for i, k in zip(first[often], n[often].tolist()):
                counts[units.data[units.starts[i] : units.ends[i]].tobytes()] += k
            if len(counts) > SUMMARY_ENTRIES:
                counts = Counter(dict(top(SUMMARY_ENTRIES // 2)))
    sent = top(SUMMARY_SENT)
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in sent], pa.binary()), pa.array([n for _, n in sent], pa.int64())], ["unit", "n"]
    )


class HashTable:
    """Open addressing over two arrays; looked up for whole arrays of hashes."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, slots: int = SLOTS):
        self.keys, self.values = np.zeros(slots, np.uint64), np.full(slots, -1, np.int32)
        self.probes, self.mask = 0, np.uint64(slots - 1)
        for key, value in zip(keys.tolist(), values.tolist()):
            at, steps = key & (slots - 1), 1
            while self.values[at] >= 0:
                at, steps = (at + 1) & (slots - 1), steps + 1
            self.keys[at], self.values[at] = key, value
            self.probes = max(self.probes, steps)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """Values, -1 for unknown hashes."""
        out = np.full(len(hashes), -1, np.int32)
        left = np.arange(len(hashes))
        at = hashes & self.mask
        for _ in range(self.probes):
            found = (self.keys[at] == hashes[left]) & (self.values[at] >= 0)
            out[left[found]] = self.values[at[found]]
            more = ~found & (self.values[at] >= 0)
            left, at = left[more], (at[more] + np.uint64(1)) & self.mask
            if not len(left):
                break
        return out


def frequent_units(docs: DataFrame, text_col: str = "text", entries: int = TABLE_ENTRIES) -> list[bytes]:
    """Frequent units of a sample of documents, at most ``entries``."""
    texts = docs.select(text_of(text_col).alias("text"))
    rows = docs.count()
    if rows > SAMPLE_ROWS:
        texts = texts.sample(SAMPLE_ROWS / rows, seed=1)
    sent = texts.repartition(SAMPLE_TASKS).mapInArrow(_summaries, "unit binary, n long")
    # at most SAMPLE_TASKS * SUMMARY_SENT rows
    counts: Counter = Counter()
    for r in sent.collect():
        counts[bytes(r.unit)] += r.n
    return heapq.nlargest(entries, counts, key=lambda u: (counts[u], u))


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = TOKEN_LIMIT,
    entries: int = TABLE_ENTRIES,
) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    own = Units(*utf8_buffers(pa.array([u.decode() for u in frequent_units(docs, text_col, entries)], pa.string())))
    # a table of one part for each frequent unit, encoded once here
    known = PieceTable(LibraryEncoder(tokenizer_json(tokenizer_path)), [np.uint32], 2 * entries + 1)
    rows = known.lookup(own)
    table = spark.sparkContext.broadcast(HashTable(own.hashes(), known.payloads[0].lengths[rows]))
    vocabulary = broadcast_tokenizer(spark, tokenizer_path)
    key = tokenizer_path

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = table.value

        def build() -> PieceTable:
            encoder = LibraryEncoder(vocabulary.value)
            return PieceTable(encoder, [encoder.dtype], CACHE_ENTRIES)

        cache = worker_state(("counts", key), build)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                units = _units(part)
                n = frequent.get(units.hashes())
                rare = np.flatnonzero(n < 0)
                rows = cache.lookup(units, rare)
                n[rare] = cache.payloads[0].lengths[rows]
                total = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "id"),
                        pa.array(np.diff(units.offsets)),
                        pa.array(total[units.ptr[1:]] - total[units.ptr[:-1]]),
                    ],
                    ["id", "n_bytes", "n_tokens"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    counted = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(
        count, f"id {kind}, n_bytes long, n_tokens long"
    )
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
