"""Near-duplicate detection by fast similarity sketching, banding and exact checks.

Sketch: in round i every shingle is thrown by a fresh hash into one of T bins
with the value i + fraction, and a bin keeps its minimum; rounds T to 2T - 1
throw everything into bin i - T, so every bin is filled after 2T rounds.  Large
sets fill all bins in one round, and the share of equal bins of two sets is
concentrated about their similarity as T independent samples would be.

1. Documents with equal shingle sets form a class; one row per class goes on
   (a group of copies of any size shrinks to one row, pre-aggregated).
2. Classes that agree on all rows of a band share a bucket; of buckets with the
   same classes one is kept.
3. Buckets are dealt out in blocks of bounded size.  Within a block a maximum
   spanning forest over the estimated similarities names at most one pair per
   member; those pairs are confirmed on full sets, and links are contracted.
4. In buckets that still hold several components, every member outside the
   bucket's largest component is compared with all members of other
   components, block by block, so no pair inside a component is ever looked
   at.  The blocks hold sketches and parity vectors (which of many small parts
   of a set are odd: what two sets differ by in them can't be shared, an exact
   bound); texts travel only for the pairs that pass both, once per text.
   First the best pair of an outsider with each component is confirmed on full
   sets, then all pairs that are not connected yet.
5. Components of all confirmed links.

A pair at the threshold shares no bucket with probability below 4e-6, and is
estimated below the cut with probability below 1e-7 (by the binomial); both
fall quickly above the threshold.  Everything else is exact: links are only
made by full sets.

Defined results: null text counts as empty; documents without words have an
empty set, are linked with nothing and are kept; fewer words than a shingle
form one shingle; a row that occurs again with the same id and text stays with
its twin (both rows are reported, :func:`drop_near_duplicates` keeps one); null
ids are larger than any id; an empty table gives an empty table; other columns
are carried through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import column, materialise, release_state, sized, slices, text_of, utf8_buffers
from shoplens.llm.components import components
from shoplens.llm.parity import Vectors, needed, parities
from shoplens.llm.words import NON_SPACE, Words, mix, windows

SHINGLE_WORDS = 5
THRESHOLD = 80  # per cent
BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
#: Pairs with fewer equal bins are not worth a look: 5.5 standard deviations below the threshold, which
#: loses fewer pairs than the bands do.
CUT = 100
BLOCK_ROWS = 1024
_SEEDS = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 2 * BINS, dtype=np.uint64)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_FRACTION = np.uint64((1 << 48) - 1)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and their pointer per text."""
    offsets, data = utf8_buffers(texts)
    words = Words(offsets, data, NON_SPACE, lower=True)
    hashes = words.hashes()
    found, ptr = windows(hashes, words.ptr, size)
    sets = []
    for d, n in enumerate(words.counts):
        if n >= size:
            sets.append(np.unique(found[ptr[d] : ptr[d + 1]]))
        elif n:
            # the whole sequence as one shingle, told apart from longer ones by its length
            short = np.uint64(n)
            for h in hashes[words.ptr[d] : words.ptr[d + 1]]:
                short = mix(np.array([short ^ h], np.uint64))[0]
            sets.append(np.array([short], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    out = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return out, np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)


def sketches(elements: np.ndarray, ptr: np.ndarray, bins: int = BINS, seeds: np.ndarray = _SEEDS) -> np.ndarray:
    """The sketch of each set, one row each; rows of empty sets stay empty."""
    n = len(ptr) - 1
    out = np.full(n * bins, _EMPTY, np.uint64)
    of = np.repeat(np.arange(n), np.diff(ptr))
    for i in range(2 * bins):
        if not len(elements):
            break
        h = mix(elements ^ seeds[i])
        if i < bins:
            at = ((h >> np.uint64(48)) * np.uint64(bins) >> np.uint64(16)).astype(np.int64)
        else:
            at = np.full(len(h), i - bins)
        np.minimum.at(out, of * bins + at, np.uint64(i) << np.uint64(48) | (h & _FRACTION))
        unfilled = (out.reshape(n, bins) == _EMPTY).any(1)[of]
        elements, of = elements[unfilled], of[unfilled]
    return out.reshape(n, bins)


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        for batch in batches:
            for part in slices(batch, "text"):
                elements, ptr = shingle_sets(column(part, "text"), size)
                odd = parities(elements, ptr)
                short = (sketches(elements, ptr) & np.uint64(0xFFFF)).astype("<u2")
                sets = [elements[a:b] for a, b in zip(ptr[:-1], ptr[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "id"),
                        column(part, "print"),
                        pa.array(np.diff(ptr), pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([row.tobytes() if len(s) else None for row, s in zip(short, sets)], pa.binary()),
                        pa.array(odd, pa.binary()),
                    ],
                    ["id", "print", "n_shingles", "cls", "sketch", "parity"],
                )

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys of a sorted partition; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([column(batch, k).to_numpy(zero_copy_only=False) for k in keys], 1)
        cuts = [0, *(np.flatnonzero((rows[1:] != rows[:-1]).any(1)) + 1), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            key = tuple(rows[lo])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<u2").reshape(-1, BINS)


def _pairs(first: list, second: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(first, pa.binary()), pa.array(second, pa.binary())], ["a", "b"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, the pairs of a maximum spanning forest over the estimates that reach the cut."""
    release_state()
    first: list[bytes] = []
    second: list[bytes] = []
    for group in _groups(batches, ["bucket", "block"]):
        m = group.num_rows
        if m > 1:
            cls, sketch = group.column("cls").to_pylist(), _matrix(group.column("sketch"))
            best, parent, open_ = np.full(m, -1), np.zeros(m, np.int64), np.ones(m, bool)
            for _ in range(m):
                v = int(np.argmax(np.where(open_, best, -2)))
                open_[v] = False
                if best[v] >= CUT:
                    first.append(max(cls[v], cls[parent[v]]))
                    second.append(min(cls[v], cls[parent[v]]))
                equal = (sketch == sketch[v]).sum(1)
                closer = equal > best
                best[closer], parent[closer] = equal[closer], v
        if len(first) > 10_000:
            yield _pairs(first, second)
            first, second = [], []
    yield _pairs(first, second)


def _across(threshold: int, best: bool):
    """Pairs of different components between a block of members and a block of outsiders that may be links.

    ``best``: of an outsider and a component only the pair with the highest estimate.
    """

    def pairs(group: pa.Table) -> Iterator[tuple[bytes, bytes]]:
        side = np.array(group.column("as_outsider").to_pylist())
        outsider = np.array(group.column("outsider").to_pylist())
        cls, comp = group.column("cls").to_pylist(), group.column("component").to_pylist()
        number = {c: i for i, c in enumerate(dict.fromkeys(comp))}
        own = np.array([number[c] for c in comp])
        sketch, n = _matrix(group.column("sketch")), group.column("n").to_numpy()
        vectors = Vectors(group.column("parity").to_pylist())
        members = np.flatnonzero(~side)
        for o in np.flatnonzero(side).tolist():
            x = members[own[members] != own[o]]
            equal = (sketch[x] == sketch[o]).sum(1)
            x, equal = x[equal >= CUT], equal[equal >= CUT]
            most = (n[x] + n[o] - vectors.apart(x, np.full(len(x), o))) // 2
            fit = most >= needed(n[x], np.full(len(x), n[o]), threshold)
            x, equal = x[fit], equal[fit]
            x = x[np.argsort(-equal, kind="stable")]
            if best:
                x = x[np.sort(np.unique(own[x], return_index=True)[1])]
            for y in x.tolist():
                # two outsiders meet twice; one meeting is enough
                if best or not outsider[y] or cls[y] < cls[o]:
                    yield max(cls[y], cls[o]), min(cls[y], cls[o])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        out: set[tuple[bytes, bytes]] = set()
        for group in _groups(batches, ["bucket", "block", "out_block"]):
            for pair in pairs(group):
                out.add(pair)
                if len(out) > 20_000:
                    yield _pairs(*zip(*out))
                    out.clear()
        yield _pairs(*(zip(*out) if out else ((), ())))

    return run


def similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Does the similarity of two sorted sets reach ``threshold`` per cent?"""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= threshold * (len(a) + len(b) - both)


def _confirm(size: int, threshold: int):
    """Keep the pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        for batch in batches:
            for part in slices(batch, "text_a", 1 << 19):
                sets_a, ptr_a = shingle_sets(column(part, "text_a"), size)
                sets_b, ptr_b = shingle_sets(column(part, "text_b"), size)
                keep = [
                    similar(sets_a[ptr_a[i] : ptr_a[i + 1]], sets_b[ptr_b[i] : ptr_b[i + 1]], threshold)
                    for i in range(part.num_rows)
                ]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class NearDuplicates:
    """The stages over one table; every intermediate is a table in the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, threshold: int):
        self.size, self.threshold = size, threshold
        self.kind = docs.schema[id_col].dataType.simpleString()
        text = text_of(text_col)
        self.rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("print"))

    def signatures(self) -> DataFrame:
        schema = f"id {self.kind}, print long, n_shingles long, cls binary, sketch binary, parity binary"
        return materialise(self.rows.mapInArrow(_signatures(self.size), schema), "near-signatures")

    @staticmethod
    def classes(signatures: DataFrame) -> DataFrame:
        """One row per distinct set: its sketch and its first document."""
        first = F.struct(F.col("id").isNull().alias("no_id"), "id", "print")
        own = signatures.where(F.col("cls").isNotNull()).groupBy("cls")
        own = own.agg(
            F.any_value("sketch").alias("sketch"), F.any_value("parity").alias("parity"), F.any_value("n_shingles").alias("n"),
            F.min(first).alias("first"),
        )
        return materialise(own.select("cls", "sketch", "parity", "n", "first.id", "first.print"), "near-classes")

    @staticmethod
    def members(classes: DataFrame) -> DataFrame:
        """(bucket, block, cls) of buckets with several classes, each set of classes once."""
        buckets = [F.xxhash64(F.lit(b), F.substring("sketch", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)]
        banded = classes.select("cls", F.explode(F.array(*buckets)).alias("bucket"))
        several = banded.groupBy("bucket").count().where("count > 1")
        several = materialise(several.select(F.col("bucket").alias("s_bucket")), "near-shared")
        rows = banded.join(sized(several, 16), F.col("bucket") == F.col("s_bucket")).select("bucket", "cls")
        rows = materialise(rows, "near-shared-rows")
        sets = rows.groupBy("bucket").agg(F.count("*").alias("count"), F.bit_xor(F.xxhash64("cls")).alias("all"))
        sets = sets.groupBy("count", "all").agg(F.min("bucket").alias("k_bucket"))
        sets = materialise(sets.select("k_bucket", "count"), "near-buckets")
        blocks = F.ceil(F.col("count") / BLOCK_ROWS).cast("int")
        rows = rows.join(sized(sets, 24), F.col("bucket") == F.col("k_bucket"))
        return materialise(rows.select("bucket", F.pmod(F.xxhash64("cls"), blocks).cast("int").alias("block"), "cls"), "near-members")

    def texts(self, named: DataFrame, classes: DataFrame) -> DataFrame:
        """(cls, text) of the classes in ``named`` (distinct)."""
        named = materialise(named.join(classes.select("cls", "id", "print"), "cls"), "near-named")
        here = named.select("cls", F.col("id").alias("c_id"), F.col("print").alias("c_print"))
        rows = self.rows.join(
            sized(here, 64), (F.col("print") == F.col("c_print")) & F.col("id").eqNullSafe(F.col("c_id"))
        )
        return materialise(rows.select("cls", "text").dropDuplicates(["cls"]), "near-texts")

    def confirmed(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs that are links; texts travel only for classes that are in a pair."""
        named = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
        texts = self.texts(named, classes)
        both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
        both = both.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
        both = both.select("a", "b", "text_a", "text_b")
        return materialise(both.mapInArrow(_confirm(self.size, self.threshold), "a binary, b binary"), "near-links")

    @staticmethod
    def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.repartition(*keys).sortWithinPartitions(*keys)

    def forest_pairs(self, members: DataFrame, classes: DataFrame) -> DataFrame:
        rows = members.join(classes.select("cls", "sketch"), "cls").select("bucket", "block", "cls", "sketch")
        pairs = self._dealt(rows, "bucket", "block").mapInArrow(_forest, "a binary, b binary")
        return materialise(pairs.distinct(), "near-pairs")

    def remaining_pairs(self, members: DataFrame, classes: DataFrame, of: DataFrame, best: bool) -> DataFrame:
        """Pairs across components that share a bucket and may be links."""
        placed = members.drop("block").join(of, F.col("cls") == F.col("node"), "left").drop("node")
        placed = materialise(placed.withColumn("component", F.coalesce("component", "cls")), "near-placed")
        sizes = placed.groupBy("bucket", "component").count().groupBy("bucket")
        sizes = sizes.agg(
            F.max_by("component", F.struct("count", "component")).alias("largest"),
            F.sum("count").alias("all"),
            (F.sum("count") - F.max("count")).alias("outside"),
        )

        def parts(n: str):
            return F.ceil(F.col(n) / BLOCK_ROWS).cast("int")

        # the only pair of a bucket of two has been confirmed or lies below the cut
        unresolved = sizes.where("outside > 0 and all > 2").select(
            "bucket", "largest", parts("all").alias("blocks"), parts("outside").alias("out_blocks")
        )
        unresolved = materialise(unresolved, "near-unresolved")
        rows = placed.join(sized(unresolved, 64), "bucket")
        rows = materialise(rows.withColumn("outsider", F.col("component") != F.col("largest")), "near-unplaced")
        rows = rows.join(classes.select("cls", "sketch", "parity", "n"), "cls")

        def own(n: str):
            return F.pmod(F.xxhash64("cls", F.lit(n)), n).cast("int")

        def each(n: str):
            return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

        columns = ["bucket", "block", "out_block", "cls", "component", "sketch", "parity", "n", "outsider", "as_outsider"]
        as_member = rows.withColumn("block", own("blocks")).withColumn("out_block", each("out_blocks"))
        as_outsider = rows.where("outsider").withColumn("out_block", own("out_blocks")).withColumn("block", each("blocks"))
        both = as_member.withColumn("as_outsider", F.lit(False)).select(*columns)
        both = both.unionByName(as_outsider.withColumn("as_outsider", F.lit(True)).select(*columns))
        dealt = self._dealt(both, "bucket", "block", "out_block")
        return dealt.mapInArrow(_across(self.threshold, best), "a binary, b binary").distinct()

    def find(self) -> DataFrame:
        """(id, print, n_shingles, component_id): one row per document."""
        signatures = self.signatures()
        classes = self.classes(signatures)
        members = self.members(classes)
        checked = self.forest_pairs(members, classes)
        links = self.confirmed(checked, classes)
        of = materialise(components(links), "near-of")
        for best in (True, False):
            pairs = self.remaining_pairs(members, classes, of, best).join(checked, ["a", "b"], "left_anti")
            pairs = materialise(pairs, "near-more-pairs")
            if pairs.isEmpty():
                continue
            found = self.confirmed(pairs, classes)
            checked = checked.unionByName(pairs)
            if not found.isEmpty():
                links = links.unionByName(found)
                of = materialise(components(links), "near-of")
        # the smallest id of every component of several classes, then of every class
        named = classes.select("cls", "id").join(of, F.col("cls") == F.col("node"), "left")
        named = named.withColumn("component", F.coalesce("component", "cls")).drop("node")
        lowest = named.groupBy("component").agg(F.min("id").alias("component_id"))
        class_id = materialise(named.join(lowest, "component").select("cls", "component_id"), "near-class-ids")
        rows = signatures.select("id", "print", "n_shingles", "cls").join(sized(class_id, 48), "cls", "left")
        alone = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
        return rows.select("id", "print", "n_shingles", alone.alias("component_id"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    found = NearDuplicates(docs, id_col, text_col, shingle_words, threshold).find()
    return found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id."""
    found = NearDuplicates(docs, id_col, text_col, shingle_words, threshold).find()
    out = found.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("id", "print").distinct()
    out = materialise(out, "near-dropped").select(F.col("id").alias("o_id"), F.col("print").alias("o_print"))
    text = text_of(text_col)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("print"))
    dropped = F.col("id").eqNullSafe(F.col("o_id")) & (F.col("print") == F.col("o_print"))
    kept = rows.join(sized(out, 32), dropped, "left_anti")
    # rows that occur again with the same id and text: only those are shuffled whole
    again = materialise(
        rows.groupBy("id", "print").count().where("count > 1").select(F.col("id").alias("r_id"), F.col("print").alias("r_print")),
        "near-repeats",
    )
    repeated = F.col("id").eqNullSafe(F.col("r_id")) & (F.col("print") == F.col("r_print"))
    single = kept.join(sized(again, 32), repeated, "left_anti")
    several = kept.join(sized(again, 32), repeated, "left_semi").dropDuplicates(["id", "print"])
    return single.select("row.*").unionByName(several.select("row.*"))
