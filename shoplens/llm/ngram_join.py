"""N-gram Jaccard join: rare-first prefix filtering, then exact checks.

Two sets of sizes x and y have a similarity of t or more only if they share
``need = ceil(t (x + y) / (1 + t))`` n-grams.  In any order of all n-grams that
all documents follow, two such sets share one of their first
``x - ceil(t x) + 1`` and ``y - ceil(t y) + 1`` n-grams, so it is enough to
join on those prefixes.  The order here puts rare n-grams first, so that what
many documents share (templates, passages) is joined on only by documents that
have little else.

1. One pass makes the sets (64-bit hashes), a parity vector of each, and counts
   all n-grams of all documents in a fixed number of counters.  A counter far
   above the average holds a frequent n-gram; its level is the logarithm of the
   surplus.  N-grams are ordered by (level, hash).  Levels decide speed alone:
   any order gives the same links.
2. Documents with equal sets form a class; classes are joined, not copies.
3. A second pass emits the prefixes, which are dealt out by n-gram, once.
   N-grams in the prefixes of one class only are dropped, and of n-grams with
   the same classes one is kept.
4. The classes of an n-gram are dealt into blocks.  A pair passes if its sizes
   agree (length filter), if the n-grams before and after the shared one can
   still make up ``need`` (positional filter), and if the rest leaves room for
   it (suffix filter: both sets are parted into the same many small parts; a
   part that is odd in one and even in the other holds an n-gram that is not
   shared).  Small blocks send all such pairs; large ones the pairs of a
   maximum spanning forest over the bound that the last filter gives.
5. These pairs are checked on full sets, and links make components.
6. N-grams with many classes that are not connected by then: classes outside
   the largest component meet all classes of other components, block by block.
   First the best pair of a class with each component is checked, then every
   pair that passes the filters and is not connected yet; each pair once.

No pair inside a component is looked at again, so a group of n near copies
costs about n checks.  Every link between classes of different components is
found; the filters lose none.

Defined results: null text counts as empty; documents without words have an
empty set and are linked with nothing; fewer words than an n-gram form one
n-gram; a row that occurs again is reported again; null ids are larger than any
id; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import column, materialise, release_state, sized, slices, text_of
from shoplens.llm.components import components
from shoplens.llm.near_dedup import shingle_sets, similar
from shoplens.llm.parity import Vectors, needed, parities

NGRAM_WORDS = 5
THRESHOLD = 80  # per cent
COUNTER_BITS, PARTS = 22, 1024
#: Partial counters are summed in so many groups, then over the groups.
SUM_GROUPS = 8
#: Up to so many classes all pairs that pass the filters are sent at once.
SMALL = 16
BLOCK = 1024
#: Deviations above the average from which a counter is taken to hold a frequent n-gram.
DEVIATIONS = 6
SEEN_CLASSES = 200_000


def prefix_lengths(n: np.ndarray, threshold: int) -> np.ndarray:
    """How many n-grams of sets of these sizes are joined on."""
    return np.where(n > 0, n + (-threshold * n // 100) + 1, 0)


def classes_of(elements: np.ndarray, ptr: np.ndarray) -> list[bytes | None]:
    return [hashlib.blake2b(elements[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(ptr[:-1], ptr[1:])]


class Counters:
    """How often n-grams occur, in a fixed number of counters; sent on in parts."""

    def __init__(self):
        self.counts, self.waiting, self.n = np.zeros(1 << COUNTER_BITS, np.int64), [], 0

    def add(self, elements: np.ndarray) -> None:
        self.waiting.append((elements >> np.uint64(64 - COUNTER_BITS)).astype(np.int64))
        self.n += len(elements)
        if self.n > 1 << 21:
            self.settle()

    def settle(self) -> None:
        if self.n:
            self.counts += np.bincount(np.concatenate(self.waiting), minlength=len(self.counts))
        self.waiting, self.n = [], 0

    def parts(self) -> Iterator[tuple[int, bytes]]:
        self.settle()
        for part, counts in enumerate(np.split(self.counts, PARTS)):
            if counts.any():
                yield part, packed(counts)


def packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as they need."""
    top = int(counts.max())
    return counts.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    each = (1 << COUNTER_BITS) // PARTS
    return np.frombuffer(raw, f"<u{len(raw) // each}").astype(np.int64)


def _measure(size: int):
    names = ["id", "print", "n_shingles", "cls", "key", "parity", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        counters, kind = Counters(), None
        for batch in batches:
            kind = batch.schema.field("id").type
            for part in slices(batch, "text"):
                elements, ptr = shingle_sets(column(part, "text"), size)
                counters.add(elements)
                own = classes_of(elements, ptr)
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "id"), column(part, "print"), pa.array(np.diff(ptr), pa.int64()), pa.array(own, pa.binary()),
                        pa.array([class_key(c) if c else None for c in own], pa.int64()),
                        pa.array(parities(elements, ptr), pa.binary()), pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary()),
                    ],
                    names,
                )
        for part, counts in counters.parts():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), *(pa.nulls(1, k) for k in (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary())), pa.array([part], pa.int32()), pa.array([counts], pa.binary())],
                names,
            )

    return run


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of runs of equal (part, grp) of a sorted partition."""
    release_state()
    key, total = None, np.zeros(0, np.int64)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([packed(total)], pa.binary())], ["part", "grp", "counts"])

    for batch in batches:
        for r in batch.to_pylist():
            if (now := (r["part"], r["grp"])) != key:
                if key:
                    yield row()
                key, total = now, np.zeros((1 << COUNTER_BITS) // PARTS, np.int64)
            total += unpacked(r["counts"])
    if key:
        yield row()


def levels_of(counts: np.ndarray) -> np.ndarray:
    """0 for counters near the average, else the logarithm of the surplus."""
    mean = counts.mean() if len(counts) else 0.0
    surplus = counts - mean
    frequent = surplus > DEVIATIONS * np.sqrt(mean) + 8
    return np.where(frequent, 1 + np.log2(np.maximum(surplus, 1)), 0).astype(np.uint8)


def prefixes(elements: np.ndarray, ptr: np.ndarray, levels: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of the prefixes, the set of each and its place there."""
    n = np.diff(ptr)
    of = np.repeat(np.arange(len(n)), n)
    # sets are sorted by hash, so a stable sort by (set, level) gives the order
    level = levels[elements >> np.uint64(64 - COUNTER_BITS)]
    order = np.argsort(of << 8 | level, kind="stable")
    place = np.arange(len(elements)) - np.repeat(ptr[:-1], n)
    chosen = place < prefix_lengths(n, threshold)[of]
    return elements[order[chosen]], of[chosen], place[chosen]


def _prefixes(size: int, threshold: int, levels: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        seen: set[bytes] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                elements, ptr = shingle_sets(column(part, "text"), size)
                own = classes_of(elements, ptr)
                fresh = np.zeros(len(own), bool)
                for i, c in enumerate(own):
                    # a copy of what this task has sent already adds nothing
                    if c is not None and c not in seen:
                        fresh[i] = True
                        seen.add(c)
                if len(seen) > SEEN_CLASSES:
                    seen.clear()
                grams, of, place = prefixes(elements, ptr, levels.value, threshold)
                keys = np.array([class_key(c) if c else 0 for c in own], np.int64)
                kept = fresh[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[kept].view(np.int64)), pa.array(keys[of[kept]]), pa.array(place[kept], pa.int32())],
                    ["gram", "key", "place"],
                )

    return run


def class_key(cls: bytes) -> int:
    """64 bits of a class's digest."""
    return int.from_bytes(cls[:8], "little", signed=True)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition sorted by (gram, key), the distinct rows of n-grams with several keys.

    A row waits until the next key of its n-gram comes, or the next n-gram; nothing else is held.
    """
    release_state()
    names = ["gram", "key", "place"]
    waiting = np.zeros((0, 3), np.int64)  # the last row so far, if it is the only one of its n-gram
    last = None  # the last (gram, key) so far
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([column(batch, c).to_numpy().astype(np.int64) for c in names], 1)
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        new[0] = last is None or tuple(rows[0, :2]) != last
        rows, before = rows[new], last
        if not len(rows):
            continue
        last = tuple(rows[-1, :2])
        # the last row of the batch before takes part as its neighbour's twin, and is sent if it still waits
        same = np.zeros(len(rows) + 1, bool)
        same[1:-1] = rows[1:, 0] == rows[:-1, 0]
        same[0] = before is not None and rows[0, 0] == before[0]
        shared = same[:-1] | same[1:]
        out = [waiting] if same[0] else []
        if shared[-1]:
            waiting = waiting[:0]
        else:
            waiting = rows[-1:]
        out.append(rows[shared])
        sent = np.concatenate(out)
        yield pa.RecordBatch.from_arrays([pa.array(sent[:, 0]), pa.array(sent[:, 1]), pa.array(sent[:, 2].astype(np.int32))], names)


class Members:
    """Classes that share an n-gram: sizes, places of the n-gram, parity vectors."""

    def __init__(self, table: pa.Table):
        self.cls = table.column("cls").to_pylist()
        self.n = table.column("n").to_numpy()
        self.place = table.column("place").to_numpy().astype(np.int64)
        self.vectors = Vectors(table.column("parity").to_pylist())


def bounds(m: Members, i: np.ndarray, j: np.ndarray, threshold: int) -> np.ndarray:
    """How much pairs can share at most, in thousandths of what they need; 0 for pairs that a filter drops."""
    x, y, p, q = m.n[i], m.n[j], m.place[i], m.place[j]
    need = needed(x, y, threshold)
    out = np.zeros(len(x), np.int64)
    # length and positional filters: at most min(p, q) shared before, the rest behind
    left = np.flatnonzero((np.minimum(x, y) >= need) & (np.minimum(p, q) + 1 + np.minimum(x - p - 1, y - q - 1) >= need))
    most = (x[left] + y[left] - m.vectors.apart(i[left], j[left])) // 2
    out[left] = np.where(most >= need[left], 1000 * most // need[left], 0)
    return out


def _pairs(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary()) for i in range(2)], ["a", "b"])


def _ordered_pair(x: bytes, y: bytes) -> tuple[bytes, bytes]:
    return max(x, y), min(x, y)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of a sorted partition, at least ``rows`` rows at a time, and where groups begin (and the last ends).

    Only the rows of the last, unfinished group wait.
    """
    held: pa.Table | None = None

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in keys:
            values = table.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.append(np.flatnonzero(new), table.num_rows)

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) < rows:
            continue
        table = pa.Table.from_batches(waiting)
        table = pa.concat_tables([held, table]) if held is not None else table
        at = starts(table)
        if len(at) > 2:
            yield table.slice(0, at[-2]), at[:-1]
        held, waiting = table.slice(at[-2]), []
    if waiting:
        table = pa.Table.from_batches(waiting)
        held = pa.concat_tables([held, table]) if held is not None else table
    if held is not None and held.num_rows:
        yield held, starts(held)


def _blocks(threshold: int):
    """Pairs of each (gram, block): all of a small block, a maximum spanning forest of a large one."""

    def small(m: Members, at: np.ndarray) -> list[tuple]:
        sizes = np.diff(at)
        of = np.repeat(np.arange(len(sizes)), sizes)
        fits = (sizes <= SMALL)[of]
        out = []
        for step in range(1, min(SMALL, int(sizes.max()))):
            i = np.flatnonzero((of[:-step] == of[step:]) & fits[:-step])
            bound = bounds(m, i, i + step, threshold)
            out += [_ordered_pair(m.cls[a], m.cls[a + step]) for a in i[bound > 0].tolist()]
        return out

    def large(m: Members, lo: int, hi: int) -> list[tuple]:
        n, out = hi - lo, []
        rows = np.arange(lo, hi)
        best, parent, open_ = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
        for _ in range(n):
            v = int(np.argmax(np.where(open_, best, -1)))
            open_[v] = False
            if best[v] > 0:
                out.append(_ordered_pair(m.cls[lo + v], m.cls[lo + parent[v]]))
            bound = bounds(m, np.full(n, lo + v), rows, threshold)
            closer = (bound > best) & open_
            best[closer], parent[closer] = bound[closer], v
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        for table, at in _runs(batches, ["gram", "block"], 4 * BLOCK):
            members = Members(table)
            out = small(members, at)
            for lo, hi in zip(at[:-1], at[1:]):
                if hi - lo > SMALL:
                    out += large(members, lo, hi)
            yield _pairs(list(set(out)))

    return run


def _across(threshold: int, best: bool):
    """Pairs between a block of outsiders and a block of members of other components.

    ``best``: of an outsider and a component only the pair with the highest bound.
    """

    def pairs(m: Members, group: pa.Table) -> Iterator[tuple[bytes, bytes]]:
        outsider = np.array(group.column("outsider").to_pylist(), bool)
        guest = np.array(group.column("as_outsider").to_pylist(), bool)
        number = {c: i for i, c in enumerate(dict.fromkeys(group.column("component").to_pylist()))}
        component = np.array([number[c] for c in group.column("component").to_pylist()])
        rows = np.flatnonzero(~guest)
        for o in np.flatnonzero(guest).tolist():
            j = rows[component[rows] != component[o]]
            bound = bounds(m, np.full(len(j), o), j, threshold)
            order = np.argsort(-bound, kind="stable")
            order = order[bound[order] > 0]
            if best:
                order = order[np.sort(np.unique(component[j[order]], return_index=True)[1])]
            for k in j[order].tolist():
                # two outsiders meet twice; one meeting is enough
                if best or not outsider[k] or m.cls[k] < m.cls[o]:
                    yield _ordered_pair(m.cls[k], m.cls[o])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        out: set[tuple] = set()
        for table, at in _runs(batches, ["gram", "block", "out_block"], 1):
            for lo, hi in zip(at[:-1], at[1:]):
                group = table.slice(lo, hi - lo)
                for pair in pairs(Members(group), group):
                    out.add(pair)
                    if len(out) > 20_000:
                        yield _pairs(list(out))
                        out.clear()
        yield _pairs(list(out))

    return run


def _check(size: int, threshold: int):
    """Keep the pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        for batch in batches:
            for part in slices(batch, "text_a"):
                x, at = shingle_sets(column(part, "text_a"), size)
                y, to = shingle_sets(column(part, "text_b"), size)
                keep = [similar(x[at[i] : at[i + 1]], y[to[i] : to[i + 1]], threshold) for i in range(part.num_rows)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Links:
    """Links found so far; a pair is checked once."""

    def __init__(self, join: NgramJoin, classes: DataFrame):
        self.join, self.classes = join, classes
        self.checked: DataFrame | None = None
        self.links: DataFrame | None = None
        self.of: DataFrame | None = None

    def check(self, pairs: DataFrame) -> None:
        if self.checked is not None:
            pairs = pairs.join(self.checked, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "ngram-to-check")
        if pairs.isEmpty() and self.links is not None:
            return
        links = self.join.links(pairs, self.classes)
        self.checked = pairs if self.checked is None else self.checked.unionByName(pairs)
        if self.of is not None and links.isEmpty():
            return
        self.links = links if self.links is None else self.links.unionByName(links)
        self.of = materialise(components(self.links), "ngram-of")

    def components(self) -> DataFrame:
        return self.of


class NgramJoin:
    """The stages over one table; every intermediate is a table in the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, threshold: int):
        self.size, self.threshold = size, threshold
        self.spark = docs.sparkSession
        self.kind = docs.schema[id_col].dataType.simpleString()
        text = text_of(text_col)
        self.rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("print"))

    def measured(self) -> DataFrame:
        schema = f"id {self.kind}, print long, n_shingles long, cls binary, key long, parity binary, part int, counts binary"
        return materialise(self.rows.mapInArrow(_measure(self.size), schema), "ngram-measured")

    @staticmethod
    def levels(measured: DataFrame) -> np.ndarray:
        """Rarity of all n-grams: a table of fixed size, whatever the input."""
        parts = measured.where("part is not null")
        group = F.pmod(F.xxhash64(F.spark_partition_id(), "counts"), F.lit(SUM_GROUPS)).cast("int")
        for grp in (group, F.lit(0)):
            parts = parts.select("part", grp.alias("grp"), "counts").repartition("part", "grp").sortWithinPartitions("part", "grp")
            parts = parts.mapInArrow(_sum, "part int, grp int, counts binary")
        counts = np.zeros((PARTS, (1 << COUNTER_BITS) // PARTS), np.int64)
        for r in parts.collect():
            counts[r.part] = unpacked(r.counts)
        return levels_of(counts.reshape(-1))

    @staticmethod
    def classes(measured: DataFrame) -> DataFrame:
        """One row per distinct set: its size, histogram and first document."""
        first = F.struct(F.col("id").isNull().alias("no_id"), "id", "print")
        own = measured.where("cls is not null").groupBy("cls")
        own = own.agg(F.any_value("key").alias("key"), F.any_value("n_shingles").alias("n"), F.any_value("parity").alias("parity"), F.min(first).alias("first"))
        return materialise(own.select("cls", "key", "n", "parity", "first.id", "first.print"), "ngram-classes")

    def members(self, classes: DataFrame, levels: np.ndarray) -> DataFrame:
        """(gram, count, cls, place, n, parity) of n-grams in the prefixes of several classes."""
        table = self.spark.sparkContext.broadcast(levels)
        found = self.rows.select("text").mapInArrow(_prefixes(self.size, self.threshold, table), "gram long, key long, place int")
        rows = found.repartition("gram").sortWithinPartitions("gram", "key").mapInArrow(_shared, found.schema)
        rows = materialise(rows, "ngram-shared")
        # of n-grams with the same classes one is enough
        sets = rows.groupBy("gram").agg(F.count("*").alias("count"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("sum"))
        sets = sets.groupBy("count", "sum").agg(F.min("gram").alias("k_gram"))
        sets = materialise(sets.select("k_gram", "count"), "ngram-kept")
        rows = rows.join(sized(sets, 24), F.col("gram") == F.col("k_gram")).select("gram", "count", "key", "place")
        return materialise(rows.join(classes.select("key", "cls", "n", "parity"), "key").drop("key"), "ngram-members")

    @staticmethod
    def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.repartition(*keys).sortWithinPartitions(*keys)

    def block_pairs(self, members: DataFrame) -> DataFrame:
        blocks = F.ceil(F.col("count") / BLOCK).cast("int")
        rows = members.withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
        pairs = self._dealt(rows.drop("count"), "gram", "block").mapInArrow(_blocks(self.threshold), "a binary, b binary")
        return pairs.distinct()

    def links(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs that are links; texts travel only for classes that are in a pair."""
        pairs = pairs.select("a", "b")
        named = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
        named = materialise(named.join(classes.select("cls", "id", "print"), "cls"), "ngram-named")
        here = named.select("cls", F.col("id").alias("c_id"), F.col("print").alias("c_print"))
        texts = self.rows.join(sized(here, 64), (F.col("print") == F.col("c_print")) & F.col("id").eqNullSafe(F.col("c_id")))
        texts = materialise(texts.select("cls", "text").dropDuplicates(["cls"]), "ngram-texts")
        both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
        both = both.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
        both = both.select("a", "b", "text_a", "text_b")
        return materialise(both.mapInArrow(_check(self.size, self.threshold), "a binary, b binary"), "ngram-links")

    def pairs_across(self, members: DataFrame, of: DataFrame, best: bool) -> DataFrame:
        """Pairs across components that large blocks have left."""
        large = members.where(F.col("count") > SMALL)
        placed = large.join(sized(of, 48), F.col("cls") == F.col("node"), "left").drop("node")
        placed = materialise(placed.withColumn("component", F.coalesce("component", "cls")), "ngram-placed")
        sizes = placed.groupBy("gram", "component").count().groupBy("gram")
        sizes = sizes.agg(F.max_by("component", F.struct("count", "component")).alias("largest"), F.sum("count").alias("all"), (F.sum("count") - F.max("count")).alias("outside"))

        def blocks(n: str):
            return F.ceil(F.col(n) / BLOCK).cast("int")

        open_ = sizes.where("outside > 0").select(F.col("gram").alias("o_gram"), "largest", blocks("all").alias("blocks"), blocks("outside").alias("out_blocks"))
        rows = placed.join(sized(materialise(open_, "ngram-open"), 64), F.col("gram") == F.col("o_gram"))
        rows = rows.withColumn("outsider", F.col("component") != F.col("largest"))

        def own(n: str):
            return F.pmod(F.xxhash64("cls", F.lit(n)), n).cast("int")

        def each(n: str):
            return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

        columns = ["gram", "block", "out_block", "cls", "component", "n", "place", "parity", "outsider", "as_outsider"]
        at_home = rows.withColumn("block", own("blocks")).withColumn("out_block", each("out_blocks")).withColumn("as_outsider", F.lit(False))
        guests = rows.where("outsider").withColumn("out_block", own("out_blocks")).withColumn("block", each("blocks")).withColumn("as_outsider", F.lit(True))
        dealt = self._dealt(at_home.select(*columns).unionByName(guests.select(*columns)), "gram", "block", "out_block")
        return dealt.mapInArrow(_across(self.threshold, best), "a binary, b binary").distinct()

    def find(self) -> DataFrame:
        """(id, n_shingles, component_id): one row per document."""
        measured = self.measured()
        classes = self.classes(measured)
        members = self.members(classes, self.levels(measured))
        found = _Links(self, classes)
        found.check(self.block_pairs(members))
        for best in (True, False):
            found.check(self.pairs_across(members, found.components(), best))
        of = found.components()
        # the smallest id of every component of several classes, then of every class
        named = classes.select("cls", "id").join(of, F.col("cls") == F.col("node"), "left")
        named = named.withColumn("component", F.coalesce("component", "cls")).drop("node")
        lowest = named.groupBy("component").agg(F.min("id").alias("component_id"))
        class_id = materialise(named.join(lowest, "component").select(F.col("cls").alias("of_cls"), "component_id"), "ngram-class-ids")
        rows = measured.where("part is null").select("id", "n_shingles", "cls").join(sized(class_id, 48), F.col("cls") == F.col("of_cls"), "left")
        alone = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
        return rows.select("id", "n_shingles", alone.alias("component_id"))


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram_words: int = NGRAM_WORDS, threshold: int = THRESHOLD
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id that links lead to, itself included)."""
    found = NgramJoin(docs, id_col, text_col, ngram_words, threshold).find()
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id")
