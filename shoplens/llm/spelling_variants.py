"""Spelling variants: words one letter apart, by blocked Gram matrices of letter counts.

Words that differ by one replaced letter have letter counts at a squared
distance of 2 (lengths equal), by one inserted letter of 1 (lengths adjacent).
With the letter counts of a block of words as the rows of a matrix, one matrix
product gives all squared distances between two blocks; pairs at 2 or less are
kept and verified letter by letter.

Which blocks meet: letters are dealt into GROUPS groups, and a word's *cell* is
its number of letters of each group, so a cell holds words of one length.  One
replaced letter leaves the cell as it is or moves one letter between two
groups, one inserted letter adds one to one group.  A word therefore visits its
neighbour cells (those of its own length once for each pair, and those one
letter longer), and no other cell can hold a near word.  Cells with many
letters in all are cut into blocks of a bounded number of letters; visitors
pass through a block a chunk at a time.  A block sends on one row per word it
found near words for, never the pairs.

Defined results: null text has no words; null ids count as empty in the
checksum; words of any length are compared whole; a word that occurs again, in
whatever row, counts again; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import column, materialise, release_state, sized, text_of

MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
#: One checksum in so many loses a letter.
LOSES = 199
#: Distinct words a task holds before it sends their counts on.
HELD_WORDS = 300_000
GROUPS = 6
BLOCK_WORDS, BLOCK_LETTERS = 2048, 1 << 22
#: Pairs of one product.
CHUNK_PAIRS = 1 << 23
#: Products are exact in single precision up to this length.
SINGLE = 2000

#: Lower-case ASCII letters and all of U+00C0 to U+00FF.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_COLUMN = np.zeros(256, np.int64)
_COLUMN[LETTERS] = np.arange(len(LETTERS))


def _damaged(word: str, checksum: int) -> str:
    at = checksum % len(word)
    return word[:at] + word[at + 1 :]


def _counts(loses: int | None, least: int):
    """Partial counts of the words of a partition."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def sent(held: Counter) -> pa.RecordBatch:
        words = [w for w in held if len(w) >= least]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        held: Counter = Counter()
        for batch in batches:
            for key, text in zip(column(batch, "key").to_pylist(), column(batch, "text").to_pylist()):
                # bytes are lower-cased in ASCII alone
                own = Counter(runs.findall(text.encode().lower().decode()))
                if loses is not None:
                    start = zlib.crc32(f"{key}:".encode())
                    hit = [(w, c) for w in own if (c := zlib.crc32(w.encode(), start)) % loses == 0]
                    for word, checksum in hit:
                        held[_damaged(word, checksum)] += own.pop(word)
                held.update(own)
                if len(held) > HELD_WORDS:
                    yield sent(held)
                    held = Counter()
        yield sent(held)

    return run


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loses: int | None = None, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, n): lower-cased words of at least ``min_letters`` letters that occur ``min_count`` times or more.

    With ``loses``, an occurrence whose checksum (with the document's id) it
    divides has lost a letter.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), text_of(text_col).alias("text"))
    counted = rows.mapInArrow(_counts(loses, min_letters), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _cell() -> Column:
    """How many letters of each group a word has."""
    groups = ["".join(chr(c) for c in LETTERS if c % GROUPS == g) for g in range(GROUPS)]
    return F.array(*[(F.length("word") - F.length(F.translate("word", g, ""))).cast("int") for g in groups])


def _visited() -> Column:
    """The neighbour cells a word visits: one letter more, or one letter moved to a later group."""
    cell = F.col("cell")

    def moved(to: int, out_of: int | None) -> Column:
        return F.array(*[cell[g] + F.lit(1 if g == to else -1 if g == out_of else 0) for g in range(GROUPS)])

    longer = [moved(g, None) for g in range(GROUPS)]
    moves = [F.when(cell[a] > 0, moved(b, a)) for b in range(GROUPS) for a in range(b)]
    return F.array(*longer, *moves)


def _dealt(words: DataFrame) -> DataFrame:
    """(cell, block, guest, word, n): each word at home in one block, and a guest wherever near words may be at home."""
    homes = materialise(words.select("word", "n", _cell().alias("cell")), "spelling-words")
    room = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(BLOCK_LETTERS) / F.length("word"))))
    blocks = homes.groupBy("cell").agg(F.ceil(F.count("*") / F.first(room)).cast("int").alias("blocks"))
    blocks = materialise(blocks.withColumnRenamed("cell", "in_cell"), "spelling-cells")
    own = F.pmod(F.xxhash64("word"), "blocks").cast("int")
    at_home = homes.join(sized(blocks, 64), F.col("cell") == F.col("in_cell")).withColumn("own", own)
    # of two blocks of one cell, the words of the later one visit the earlier one
    earlier = F.when(F.col("own") > 0, F.sequence(F.lit(0), F.col("own") - 1)).otherwise(F.array().cast("array<int>"))
    rows = at_home.select("cell", F.explode(F.concat(F.array("own"), earlier)).alias("block"), "own", "word", "n")
    rows = rows.select("cell", "block", (F.col("block") != F.col("own")).alias("guest"), "word", "n")
    guests = homes.select(F.explode(_visited()).alias("cell"), "word", "n").where("cell is not null")
    guests = guests.join(sized(blocks, 64), F.col("cell") == F.col("in_cell"))
    guests = guests.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("guest"), "word", "n")
    dealt = rows.unionByName(guests)
    return dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", "guest")


class Block:
    """Words of one length: letters, letter counts, and order by number of occurrences."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n = words, n
        self.length = len(words[0])
        self.letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), self.length)
        exact = np.float32 if self.length <= SINGLE else np.float64
        width = len(LETTERS)
        at = (np.arange(len(words)) * width)[:, None] + _COLUMN[self.letters]
        self.counts = np.bincount(at.ravel(), minlength=len(words) * width).reshape(len(words), width).astype(exact)
        self.squares = (self.counts * self.counts).sum(1)
        # 0: the most frequent word, of equally frequent ones the smallest
        order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
        self.place = np.empty(len(words), np.int64)
        self.place[order] = np.arange(len(words))
        self.at_place = np.array(order)


def distances(a: Block, b: Block) -> np.ndarray:
    """Squared distances between letter counts: a Gram matrix between two blocks."""
    kind = np.promote_types(a.counts.dtype, b.counts.dtype)
    product = a.counts.astype(kind) @ b.counts.astype(kind).T
    return a.squares[:, None] + b.squares[None, :] - 2 * product


def _one_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one replaced letter, or by one letter more in ``y``."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(1) == 1
    front = np.logical_and.accumulate(x == y[:, :-1], 1).sum(1)
    back = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], 1).sum(1)
    return front + back >= x.shape[1]


def near_pairs(a: Block, b: Block, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and of ``b`` that are near words; ``same``: one block, each pair once."""
    if a.length > b.length:
        j, i = near_pairs(b, a)
        return i, j
    if b.length > a.length + 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, second = [], []
    step = max(1, CHUNK_PAIRS // len(b.words))
    for lo in range(0, len(a.words), step):
        part = Block(a.words[lo : lo + step], a.n[lo : lo + step]) if step < len(a.words) else a
        i, j = np.nonzero(distances(part, b) <= 2)
        if same:
            i, j = i[i + lo < j], j[i + lo < j]
        held = max(1, (BLOCK_LETTERS * 2) // a.length)
        for k in range(0, len(i), held):
            good = _one_apart(part.letters[i[k : k + held]], b.letters[j[k : k + held]])
            first.append(i[k : k + held][good] + lo)
            second.append(j[k : k + held][good])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(first or none), np.concatenate(second or none)


class _Found:
    """Of each word of a block: how many near words, and the first of them by place."""

    def __init__(self, block: Block):
        self.block, self.near = block, np.zeros(len(block.words), np.int64)
        self.best: list[tuple[int, str] | None] = [None] * len(block.words)

    def add(self, own: np.ndarray, others: Block, which: np.ndarray) -> None:
        np.add.at(self.near, own, 1)
        least = np.full(len(self.near), len(others.words))
        np.minimum.at(least, own, others.place[which])
        for i in np.flatnonzero(least < len(others.words)).tolist():
            j = int(others.at_place[least[i]])
            key = (-others.n[j], others.words[j])
            if self.best[i] is None or key < self.best[i]:
                self.best[i] = key

    def rows(self) -> Iterator[tuple[str, int, int, str]]:
        for i in np.flatnonzero(self.near).tolist():
            yield self.block.words[i], int(self.near[i]), -self.best[i][0], self.best[i][1]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each (cell, block): the homes are held, guests pass by in chunks."""
    release_state()
    names = ["word", "n_near", "form_n", "form"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    key, found, home_rows, guest_rows, guest_letters = None, None, [], [], 0
    out: list[tuple] = []

    def settle_homes() -> None:
        nonlocal found
        if found is None and home_rows:
            own = Block([w for w, _ in home_rows], [n for _, n in home_rows])
            found = _Found(own)
            i, j = near_pairs(own, own, same=True)
            found.add(np.concatenate((i, j)), own, np.concatenate((j, i)))

    def settle_guests() -> None:
        nonlocal guest_letters
        settle_homes()
        if found is not None:
            for length in {len(w) for w, _ in guest_rows}:
                rows = [r for r in guest_rows if len(r[0]) == length]
                guests = Block([w for w, _ in rows], [n for _, n in rows])
                i, j = near_pairs(found.block, guests)
                found.add(i, guests, j)
                of_guests = _Found(guests)
                of_guests.add(j, found.block, i)
                out.extend(of_guests.rows())
        guest_rows.clear()
        guest_letters = 0

    def finish() -> None:
        nonlocal found
        settle_guests()
        if found is not None:
            out.extend(found.rows())
        home_rows.clear()
        found = None

    for batch in batches:
        for r in batch.to_pylist():
            if (now := (r["cell"], r["block"])) != key:
                finish()
                key = now
            if not r["guest"]:
                home_rows.append((r["word"], r["n"]))
                continue
            guest_rows.append((r["word"], r["n"]))
            guest_letters += len(r["word"])
            if len(guest_rows) >= 2 * BLOCK_WORDS or guest_letters > BLOCK_LETTERS:
                settle_guests()
        if len(out) > 20_000:
            yield batch_of(out)
            out.clear()
    finish()
    yield batch_of(out)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of words with near words: their number, and the most frequent one."""
    parts = _dealt(words).mapInArrow(_blocks, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    found = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last.  A form is more frequent than its word, so there are no circles.

    Each round doubles the way that has been gone.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = now.join(sized(step, 64), F.col("root") == F.col("at"), "left")
        new = joined.select("word", F.coalesce("further", "root").alias("root"), F.col("at").isNotNull().alias("went"))
        new = materialise(new, "spelling-roots")
        more = new.where("went").isEmpty()
        now = new.select("word", "root")
        if more:
            return now


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary of (word, n)."""
    words = materialise(words.select("word", "n"), "spelling-vocabulary")
    near = near_words(words).withColumnRenamed("word", "near_word")
    rows = words.join(near, F.col("word") == F.col("near_word"), "left")
    is_form = F.col("form_n") >= ratio * F.col("n")
    rows = rows.select(
        "word",
        F.when(is_form, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    rows = materialise(rows, "spelling-forms")
    of = roots(rows.where("form is not null")).withColumnRenamed("word", "of_word")
    rows = rows.join(sized(of, 64), F.col("word") == F.col("of_word"), "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
