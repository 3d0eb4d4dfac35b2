"""Token ids as Arrow files of equal-length sequences and masks.

Format of a shard (two Arrow IPC files in the shared folder):

* ``*.tokens.arrow``: record batches with two columns, ``tokens``
  (fixed-size list of ``sequence_length`` unsigned integers, 16 bits if the
  vocabulary fits) and ``mask`` (fixed-size list of booleans, a bit each: true
  for a token, false for padding).  Documents follow each other without gaps, the last sequence
  is padded.  Sequence ``i`` of a shard is a slice of a memory-mapped batch, so
  reading it copies nothing.
* ``*.index.arrow``: ``doc_id``, ``start`` (ids of the shard before it), ``n``.

Shards hold consecutive ranges of ids.  Range bounds come from quantiles of
the id column alone, so the texts are read once and only encoded ids are
shuffled.  Each task streams its shard to disk.  A file's name is unique to
the attempt that wrote it and only the manifest's files are read, so a lost or
repeated task leaves nothing wrong behind.

Defined results: null text counts as empty and gives only the end id; null ids
come first; documents with the same id follow each other by their ids' bytes,
so reruns agree; an empty table gives no shard and an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import column, materialise, shared_folder, slices, text_of, utf8_buffers, worker_state
from shoplens.llm.piece_table import PieceTable
from shoplens.llm.tokenizing import LibraryEncoder, Units, broadcast_tokenizer, id_type, tokenizer_json

SEQUENCE_LENGTH = 2048
SEQUENCES_PER_BATCH = 64
END_ID = 1
CACHE_ENTRIES = 1_500_000


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Local (mounted) folders and every store Arrow knows by its scheme."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path
    return pafs.FileSystem.from_uri(uri)


def encode_shards(
    docs: DataFrame, tokenizer_path: str, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (shard, id, ids as little-endian bytes with the end id), encoded where they are read."""
    spark = docs.sparkSession
    vocabulary = broadcast_tokenizer(spark, tokenizer_path)
    dtype = id_type(tokenizer_json(tokenizer_path), END_ID)
    steps = [i / shards for i in range(1, shards)]
    bounds = docs.select(F.percentile_approx(id_col, steps, 10_000).alias("b")).first()["b"] if steps else []
    bounds = np.array(sorted(set(bounds or [])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = vocabulary.value
        key = hashlib.sha1(text.encode()).hexdigest()
        cache = worker_state(("files", key), lambda: PieceTable(LibraryEncoder(text), [dtype], CACHE_ENTRIES))
        end = np.asarray([END_ID], dtype).tobytes()
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                units = Units(*utf8_buffers(column(part, "text")))
                rows = cache.lookup(units)
                flat, ends = cache.payloads[0].gather(rows)
                bounds_of = ends[units.ptr]
                ids = [flat[lo:hi].tobytes() + end for lo, hi in zip(bounds_of[:-1], bounds_of[1:])]
                own = column(part, "id")
                shard = [0 if i is None else int(np.searchsorted(bounds, i, "left")) for i in own.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), own, pa.array(ids, pa.binary())], ["shard", "id", "ids"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"shard int, id {kind}, ids binary")


class ShardWriter:
    """Streams ids into equal-length sequences; a partial sequence waits for more ids."""

    def __init__(self, uri: str, dtype: np.dtype, length: int, id_kind: pa.DataType):
        self.fs, self.base = _filesystem(uri)
        self.dtype, self.length = dtype, length
        self.fs.create_dir(os.path.dirname(self.base), recursive=True)
        self.kind = pa.list_(pa.from_numpy_dtype(dtype), length)
        self.mask_kind = pa.list_(pa.bool_(), length)
        self.schema = pa.schema([("tokens", self.kind), ("mask", self.mask_kind)])
        self.index_schema = pa.schema([("doc_id", id_kind), ("start", pa.int64()), ("n", pa.int64())])
        self.out = self.fs.open_output_stream(self.base + ".tokens.arrow")
        self.index_out = self.fs.open_output_stream(self.base + ".index.arrow")
        self.tokens = pa.ipc.new_file(self.out, self.schema)
        self.index = pa.ipc.new_file(self.index_out, self.index_schema)
        self.waiting: list[bytes] = []
        self.bytes = self.n_ids = self.n_docs = 0

    def add(self, ids: pa.Array, payload: list[bytes]) -> None:
        n = np.array([len(p) // self.dtype.itemsize for p in payload], np.int64)
        starts = self.n_ids + np.concatenate(([0], np.cumsum(n)[:-1]))
        self.index.write_batch(pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(n)], schema=self.index_schema))
        self.n_docs += len(payload)
        self.n_ids += int(n.sum())
        for p in payload:
            self.waiting.append(p)
            self.bytes += len(p)
            if self.bytes >= SEQUENCES_PER_BATCH * self.length * self.dtype.itemsize:
                self._flush(final=False)

    def _flush(self, final: bool) -> None:
        flat = np.frombuffer(b"".join(self.waiting), self.dtype)
        whole = len(flat) // self.length * self.length
        rest = flat[whole:]
        mask = np.ones(whole, bool)
        if final and len(rest):
            pad = self.length - len(rest)
            mask = np.concatenate((mask, np.ones(len(rest), bool), np.zeros(pad, bool)))
            flat, whole = np.concatenate((flat, np.zeros(pad, self.dtype))), whole + self.length
            rest = flat[whole:]
        if whole:
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(flat[:whole]), type=self.kind),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.mask_kind),
            ]
            self.tokens.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.waiting = [rest.tobytes()] if len(rest) else []
        self.bytes = len(rest) * self.dtype.itemsize

    def close(self) -> None:
        self._flush(final=True)
        for x in (self.tokens, self.index, self.out, self.index_out):
            x.close()


class ShardReader:
    """Random access to a shard's sequences without copying."""

    def __init__(self, uri: str):
        fs, base = _filesystem(uri)
        if isinstance(fs, pafs.LocalFileSystem):
            self.source, self.index_source = pa.memory_map(base + ".tokens.arrow"), pa.memory_map(base + ".index.arrow")
        else:
            self.source, self.index_source = fs.open_input_file(base + ".tokens.arrow"), fs.open_input_file(base + ".index.arrow")
        self.tokens, self.index = pa.ipc.open_file(self.source), pa.ipc.open_file(self.index_source)
        self.length = self.tokens.schema.field("tokens").type.list_size
        self._ends: list[int] | None = None

    def batches(self) -> Iterator[tuple[np.ndarray, pa.BooleanArray]]:
        """(ids, mask) of each record batch, flat views of the file."""
        for i in range(self.tokens.num_record_batches):
            yield self._flat(i)

    def _flat(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        batch = self.tokens.get_batch(i)
        return batch.column(0).flatten().to_numpy(zero_copy_only=True), batch.column(1).flatten()

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Tokens and mask of sequence ``i``: views of the mapped file."""
        if self._ends is None:
            self._ends = list(np.cumsum([self.tokens.get_batch(k).num_rows for k in range(self.tokens.num_record_batches)]))
        k = int(np.searchsorted(self._ends, i, "right"))
        at = (i - (self._ends[k - 1] if k else 0)) * self.length
        tokens, mask = self._flat(k)
        return tokens[at : at + self.length], mask[at : at + self.length]

    def documents(self) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """(doc_id, start, n) of each index batch."""
        for i in range(self.index.num_record_batches):
            b = self.index.get_batch(i)
            yield b.column(0), b.column(1).to_numpy(), b.column(2).to_numpy()

    def checksums(self) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, list[int]]]:
        """Index batches with the CRC-32 of each document's ids as 32-bit integers, in one pass."""
        source, flat, at = self.batches(), np.zeros(0, np.uint16), 0
        for ids, starts, sizes in self.documents():
            sums = []
            for n in sizes:
                crc, left = 0, int(n)
                while left:
                    if at == len(flat):
                        tokens, mask = next(source)
                        flat, at = tokens[: mask.true_count], 0
                    take = flat[at : at + left]
                    crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
                    at, left = at + len(take), left - len(take)
                sums.append(crc)
            yield ids, starts, sizes, sums


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    shards: int | None = None,
    sequence_length: int = SEQUENCE_LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the shards; returns their manifest: shard, uri, n_docs, n_ids (one row per shard)."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = folder or shared_folder(spark, "token-files")
    dtype = id_type(tokenizer_json(tokenizer_path), END_ID)
    rows = encode_shards(docs, tokenizer_path, shards, id_col, text_col)
    dealt = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", F.asc_nulls_first("id"), "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writers: dict[int, ShardWriter] = {}
        uris = {}
        for batch in batches:
            numbers = column(batch, "shard").to_numpy()
            for number in np.unique(numbers):
                lo, hi = int(np.searchsorted(numbers, number)), int(np.searchsorted(numbers, number, "right"))
                part = batch.slice(lo, hi - lo)
                if number not in writers:
                    for other in writers.values():
                        other.close() if other.tokens is not None else None
                        other.tokens = None
                    uris[number] = f"{folder}/shard-{number:06d}-{uuid.uuid4().hex}"
                    writers[number] = ShardWriter(uris[number], dtype, sequence_length, column(part, "id").type)
                writers[number].add(column(part, "id"), column(part, "ids").to_pylist())
        for w in writers.values():
            if w.tokens is not None:
                w.close()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(k) for k in writers], pa.int32()),
                pa.array([uris[k] for k in writers], pa.string()),
                pa.array([w.n_docs for w in writers.values()], pa.int64()),
                pa.array([w.n_ids for w in writers.values()], pa.int64()),
            ],
            ["shard", "uri", "n_docs", "n_ids"],
        )

    manifest = dealt.mapInArrow(write, "shard int, uri string, n_docs long, n_ids long")
    return materialise(manifest, "token-manifest")


def read_token_files(manifest: DataFrame, id_col: str = "doc_id", id_kind: str = "long") -> DataFrame:
    """One row per document from the files: id, start over all shards, n_tokens, ids_crc32."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard
    offsets = manifest.select("shard", "uri", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    offsets = materialise(offsets, "token-offsets")
    shards = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, offset in zip(column(batch, "uri").to_pylist(), column(batch, "offset").to_pylist()):
                for ids, starts, sizes, sums in ShardReader(uri).checksums():
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(starts + offset), pa.array(sizes), pa.array(sums, pa.int64())],
                        ["id", "start", "n_tokens", "ids_crc32"],
                    )

    rows = offsets.repartitionById(shards, F.col("shard") % shards).mapInArrow(
        read, f"id {id_kind}, start long, n_tokens long, ids_crc32 long"
    )
    return rows.withColumnRenamed("id", id_col)


def token_positions(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """Write ``docs`` and read the files back."""
    manifest = write_token_files(docs, tokenizer_path, id_col=id_col, text_col=text_col, **options)
    return read_token_files(manifest, id_col, docs.schema[id_col].dataType.simpleString())
