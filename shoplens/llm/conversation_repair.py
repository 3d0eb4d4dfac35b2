"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation has the roles ``s?(ua)+`` (initials of system, user,
assistant) or no row at all.  Each row is kept (0), given another role (3) or
deleted (4); rows without text go in anywhere (3 each); a truncated row that
stays costs 3 more; blank and duplicate rows must go.  Of the cheapest repairs
the one with the smallest audit (initials of the edits in order) is taken.

Four states (nothing yet, after s, after u, after a) hold all that the rows so
far mean for the rest.  Forward from a known state, the cheapest audits that
reach the four states have a strict order of their own, because each holds one
letter other than I per row and ends with one, so none is a prefix of another.
A vector of four costs and four ranks is therefore enough: a conversation is
cut in the middle, the forward vector of the first half meets the backward
costs of the second, the cheapest crossing with the smallest rank is the one of
the wanted repair, and both halves are solved the same way.  Memory is linear
in the rows; no table of all states is kept.

A conversation of any size is dealt out: rows are range-sorted by (conversation,
turn, ...), which splits a hot conversation over many tasks, and solved in
segments of at most 4096 rows.  A segment is one 4 x 4 matrix of costs and
ranks, the same kind of object as a single row's, so the crossings between the
segments of a large conversation are found by the same divide and conquer, over
matrices, and then each segment is solved on its own.

Defined results: null role and text count as one space; null ids form a
conversation; null turns come first; rows of one turn are ordered by role, the
text's first 64 characters and its SHA-256, so repeated rows are adjacent; an
empty role or one that begins otherwise is neither s, u nor a; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shoplens.llm.common import materialise, release_state

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NEVER = 1 << 60
#: The state after an inserted or reroled row.
TURN_TO = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: Rows without text that end a conversation: number by last state.
TAIL = (0, 2, 1, 0)
#: Rows of a segment: ids of rows are cut into blocks of so many bits.
SEGMENT_BITS = 12
#: Blocks of row ids whose matrices are composed, smallest first: a segment, an input partition, 4096 partitions, all.
LEVEL_BITS = (SEGMENT_BITS, 33, 45, 63)

SPACE = r"\x20\x09-\x0D"
BLANK, DUPLICATE = "B", "D"  # kinds of rows that must go; others are the role's initial, upper case if truncated

Matrix = tuple[tuple[int, ...], tuple[int, ...]]  # costs and ranks of the 16 ways from state to state


def _kept(state: int, initial: str) -> int | None:
    """The state after keeping a row with this initial."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


@lru_cache(maxsize=None)
def row_words(kind: str) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """For each pair of states the cheapest edits of one row (inserted rows before it included)."""
    more = TRUNCATED if kind in "SUAX" else 0
    out: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in STATES]
    for start in STATES:
        state = start
        # a third inserted row would lead back to the state after the first
        for inserted in range(3):
            ways = [(state, DELETE, "D")]
            if kind not in (BLANK, DUPLICATE):
                ways.append((TURN_TO[state], REROLE + more, "R"))
                if (after := _kept(state, kind.lower())) is not None:
                    ways.append((after, more, "K"))
            for end, cost, letter in ways:
                way = (cost + INSERT * inserted, "I" * inserted + letter)
                if out[start][end] is None or way < out[start][end]:
                    out[start][end] = way
            state = TURN_TO[state]
    return tuple(map(tuple, out))


def _ranked(costs: list[int], order: list) -> Matrix:
    """Costs with the place of each way among those from the same state."""
    ranks = [0] * 16
    for p in STATES:
        by_order = sorted((order[4 * p + q], q) for q in STATES if costs[4 * p + q] < NEVER)
        for rank, (_, q) in enumerate(by_order):
            ranks[4 * p + q] = rank
    return tuple(costs), tuple(ranks)


@lru_cache(maxsize=None)
def row_matrix(kind: str) -> Matrix:
    words = [row_words(kind)[p][q] for p in STATES for q in STATES]
    return _ranked([w[0] if w else NEVER for w in words], [w[1] if w else "" for w in words])


def forward(vector: tuple[list[int], list[int]], matrix: Matrix) -> tuple[list[int], list[int]]:
    """Costs and ranks of the four states after one more leaf."""
    (cost, rank), (costs, ranks) = vector, matrix
    new, keys = [NEVER] * 4, [0] * 4
    for q in STATES:
        best = min((min(cost[p] + costs[4 * p + q], NEVER), rank[p], p) for p in STATES)
        new[q], keys[q] = best[0], 4 * best[1] + ranks[4 * best[2] + q]
    reached = sorted((keys[q], q) for q in STATES if new[q] < NEVER)
    order = [0] * 4
    for place, (_, q) in enumerate(reached):
        order[q] = place
    return new, order


def backward(cost: list[int], matrix: Matrix) -> list[int]:
    """Costs from the four states on, with one more leaf in front."""
    costs = matrix[0]
    return [min(min(costs[4 * p + q] + cost[q] for q in STATES), NEVER) for p in STATES]


def unit(state: int) -> tuple[list[int], list[int]]:
    return [0 if q == state else NEVER for q in STATES], [0] * 4


def compose(leaves: list[Matrix]) -> Matrix:
    """The matrix of consecutive leaves."""
    costs, order = [], []
    for p in STATES:
        vector = unit(p)
        for leaf in leaves:
            vector = forward(vector, leaf)
        costs += vector[0]
        order += vector[1]
    return _ranked(costs, order)


def last_state(vector: tuple[list[int], list[int]]) -> int:
    """The state in which the wanted repair leaves the last row."""
    return min(STATES, key=lambda q: (vector[0][q] + INSERT * TAIL[q], vector[1][q]))


def crossings(leaves: list[Matrix], start: int, end: int | None) -> list[int]:
    """The states between leaves, first and last included; ``end`` None: a whole conversation."""
    if end is None:
        vector = unit(start)
        for leaf in leaves:
            vector = forward(vector, leaf)
        end = last_state(vector)
    states = [start] * (len(leaves) + 1)
    states[-1] = end
    open_ = [(0, len(leaves))]
    while open_:
        lo, hi = open_.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        vector = unit(states[lo])
        for leaf in leaves[lo:mid]:
            vector = forward(vector, leaf)
        behind = unit(states[hi])[0]
        for leaf in reversed(leaves[mid:hi]):
            behind = backward(behind, leaf)
        states[mid] = min(STATES, key=lambda q: (vector[0][q] + behind[q], vector[1][q]))
        open_ += [(lo, mid), (mid, hi)]
    return states


def row_edits(kinds: str, start: int = NOTHING, end: int | None = None, last: bool = True) -> tuple[str, ...]:
    """Edits of each row (rows inserted before it included), then of the rows behind the last one."""
    states = crossings([row_matrix(k) for k in kinds], start, end)
    words = [row_words(k)[p][q][1] for k, p, q in zip(kinds, states, states[1:])]
    return (*words, "I" * TAIL[states[-1]] if last else "")


_short_edits = lru_cache(maxsize=8192)(row_edits)


def edits(kinds: str, start: int, end: int | None, last: bool) -> tuple[str, ...]:
    return (_short_edits if len(kinds) <= 64 else row_edits)(kinds, start, end, last)


# ---------------------------------------------------------------- rows


def _or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults by the checksum of ``conv:turn``, modulo 20.

    0 drops a row, 1 empties its text, 2 takes its full stops, question and
    exclamation marks, 3 repeats it, 4 makes it the user's.
    """
    fate = F.pmod(F.crc32(F.concat(_or_space(conv_col), F.lit(":"), _or_space(turn_col))), F.lit(20))
    rows = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), fate.alias("fate"), _or_space(role_col).alias("role"),
        _or_space(text_col).alias("text"),
    )
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("fate") == 3, 2).otherwise(1)
    return rows.where("fate != 0").select(
        "conv",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), times)).alias("_one"),
    ).drop("_one")


def _ordered(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, pos): positions grow with (conversation, turn, ...) over the whole table.

    Rows that agree in everything are the same wherever they go, so a number
    of their own may split them between tasks.
    """
    rows = rows.withColumn("same", F.monotonically_increasing_id())
    keys = [
        F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64),
        F.sha2("text", 256), F.col("same"),
    ]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialise(dealt.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "repair-ordered")


def _kinds(ordered: DataFrame) -> DataFrame:
    """(conv, pos, kind) of every row, without its text."""
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    whole = F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    initial = F.substring("role", 1, 1)
    rows = ordered.select(
        "conv", "pos", "role", F.sha2("text", 256).alias("sha"), blank.alias("blank"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"), whole.alias("whole"),
    )
    said = rows.where("not blank").groupBy("conv", "role", "sha").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    again = materialise(said.where("n > 1").select(*[F.col(c).alias(f"a_{c}") for c in ("conv", "role", "sha")], "first"), "repair-again")
    same = F.col("conv").eqNullSafe(F.col("a_conv")) & (F.col("role") == F.col("a_role")) & (F.col("sha") == F.col("a_sha"))
    rows = rows.join(again, same, "left")
    kind = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("first") < F.col("pos"), DUPLICATE)
        .when(F.col("whole"), F.col("initial"))
        .otherwise(F.upper("initial"))
    )
    return rows.select("conv", "pos", kind.alias("kind"))


def _segments(kinds: DataFrame) -> DataFrame:
    """(conv, seg, kinds): the rows of a conversation in one block of positions, 4096 at most."""
    own = kinds.groupBy("conv", F.shiftright("pos", SEGMENT_BITS).alias("seg"))
    own = own.agg(F.sort_array(F.collect_list(F.struct("pos", "kind"))).alias("rows"))
    return materialise(own.select("conv", "seg", F.concat_ws("", F.col("rows.kind")).alias("kinds")), "repair-segments")


def _flat(matrix: Matrix) -> list[int]:
    return [*matrix[0], *matrix[1]]


def _matrix(flat: list[int]) -> Matrix:
    return tuple(flat[:16]), tuple(flat[16:])


def _map(rows: DataFrame, each, schema: str) -> DataFrame:
    """Rows made of rows, a batch at a time; ``each`` gives a list of dicts for a row."""
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_state()
        for batch in batches:
            yield pa.RecordBatch.from_pylist([x for row in batch.to_pylist() for x in each(row)], kind)

    return rows.mapInArrow(run, schema)


def _climb(segments: DataFrame, conv: str) -> DataFrame:
    """(conv, seg, start, end, last) of segments of conversations that have several."""
    several = segments.groupBy("conv").count().where("count > 1").select(F.col("conv").alias("s_conv"))
    nodes = _map(
        segments.join(several, F.col("conv").eqNullSafe(F.col("s_conv"))).select("conv", "seg", "kinds"),
        lambda r: [{"conv": r["conv"], "node": r["seg"], "matrix": _flat(compose([row_matrix(k) for k in r["kinds"]]))}],
        f"conv {conv}, node long, matrix array<long>",
    )
    nodes, levels = materialise(nodes, "repair-nodes"), []
    if nodes.isEmpty():
        return nodes.selectExpr("conv", "node", "cast(0 as int) start", "cast(0 as int) end", "true last")
    for lower, upper in zip(LEVEL_BITS, LEVEL_BITS[1:]):
        groups = nodes.groupBy("conv", F.shiftright("node", upper - lower).alias("parent"))
        groups = groups.agg(F.sort_array(F.collect_list(F.struct("node", "matrix"))).alias("kids"))

        def composed(r: dict) -> list[dict]:
            matrix = compose([_matrix(k["matrix"]) for k in r["kids"]])
            return [{"conv": r["conv"], "node": r["parent"], "kids": r["kids"], "matrix": _flat(matrix)}]

        nodes = _map(groups, composed, f"conv {conv}, node long, kids array<struct<node: long, matrix: array<long>>>, matrix array<long>")
        nodes = materialise(nodes, "repair-nodes")
        levels.append(nodes.select("conv", "node", "kids"))
        nodes = nodes.select("conv", "node", "matrix")
    # one node for each conversation: it begins with nothing and ends where it is cheapest
    states = nodes.selectExpr("conv", "node", "cast(0 as int) start", "cast(null as int) end", "true last")
    for level in reversed(levels):
        here = states.withColumnsRenamed({"conv": "h_conv", "node": "h_node"})
        rows = level.join(here, F.col("conv").eqNullSafe(F.col("h_conv")) & (F.col("node") == F.col("h_node")))

        def placed(r: dict) -> list[dict]:
            at = crossings([_matrix(k["matrix"]) for k in r["kids"]], r["start"], r["end"])
            return [
                {"conv": r["conv"], "node": k["node"], "start": p, "end": q, "last": r["last"] and i == len(r["kids"]) - 1}
                for i, (k, p, q) in enumerate(zip(r["kids"], at, at[1:]))
            ]

        states = _map(rows.select("conv", "node", "kids", "start", "end", "last"), placed, f"conv {conv}, node long, start int, end int, last boolean")
        states = materialise(states, "repair-states")
    return states


def _audits(segments: DataFrame, conv: str) -> DataFrame:
    """(conv, seg, kinds, words, start): edits of every row, and of the rows behind the last; the state before them."""
    states = _climb(segments, conv).withColumnsRenamed({"conv": "c_conv", "node": "c_node"})
    rows = segments.join(states, F.col("conv").eqNullSafe(F.col("c_conv")) & (F.col("seg") == F.col("c_node")), "left")

    def solved(r: dict) -> list[dict]:
        alone = r["start"] is None
        start = NOTHING if alone else r["start"]
        words = edits(r["kinds"], start, None if alone else r["end"], alone or r["last"])
        return [{"conv": r["conv"], "seg": r["seg"], "kinds": r["kinds"], "words": words, "start": start}]

    schema = f"conv {conv}, seg long, kinds string, words array<string>, start int"
    return _map(rows.select("conv", "seg", "kinds", "start", "end", "last"), solved, schema)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each segment its audit (position -1), then its rows: the rows that the edits make of them."""
    release_state()
    kinds, words, at, state = "", [], 0, NOTHING
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("conv", "pos", "k", "turn", "edit", "kind", "initial", "role", "text")}

        def emit(r: dict, k: int, turn, edit: str, kind, initial, role, text) -> None:
            for c, value in zip(out, (r["conv"], r["pos"], k, turn, edit, kind, initial, role, text)):
                out[c].append(value)

        def insert(r: dict, ks: range) -> None:
            nonlocal state
            for k in ks:
                state = TURN_TO[state]
                emit(r, k, None, "I", None, None, ROLE_OF[state], "")

        for r in batch.to_pylist():
            if r["words"] is not None:
                kinds, words, at, state = r["kinds"], r["words"], 0, r["start"]
                continue
            word, kind, role = words[at], kinds[at], r["role"]
            insert(r, range(len(word) - 1))
            if word[-1] == "R":
                state = TURN_TO[state]
                role = ROLE_OF[state]
            elif word[-1] == "K":
                state = _kept(state, kind.lower())
            emit(r, len(word) - 1, r["turn"], word[-1], kind, r["role"][:1], role, r["text"])
            at += 1
            if at == len(kinds):
                insert(r, range(len(word), len(word) + len(words[at])))
        yield pa.RecordBatch.from_pydict(out, pa.schema([*(batch.schema.field(c) for c in ("conv", "pos")), ("k", pa.int32()), batch.schema.field("turn"), *((c, pa.string()) for c in ("edit", "kind", "initial", "role", "text"))]))


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows of the repaired conversations, and those that were deleted.

    ``conv_col``; ``pos`` and ``k``, which order the rows; ``edit`` (K, R, I or
    D); role and text (as they are now; deleted rows as they were); of rows that
    were there before also ``turn``, ``initial`` (of their old role) and
    ``kind``: B blank, D duplicate, else s, u, a or x by the old role, upper
    case if truncated.
    """
    conv, turn = (rows.schema[c].dataType.simpleString() for c in (conv_col, turn_col))
    rows = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), _or_space(role_col).alias("role"), _or_space(text_col).alias("text")
    )
    ordered = _ordered(rows)
    segments = _segments(_kinds(ordered))
    audits = materialise(_audits(segments, conv), "repair-audits")
    own = ordered.select(
        "conv", F.shiftright("pos", SEGMENT_BITS).alias("seg"), "pos", "turn", "role", "text",
        F.lit(None).cast("string").alias("kinds"), F.lit(None).cast("array<string>").alias("words"), F.lit(0).alias("start"),
    )
    heads = audits.select(
        "conv", "seg", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast(turn).alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), "kinds", "words", "start",
    )
    # the audit of a segment comes before its rows
    dealt = own.unionByName(heads).repartition("conv", "seg").sortWithinPartitions("conv", "seg", "pos")
    schema = f"conv {conv}, pos long, k int, turn {turn}, edit string, kind string, initial string, role string, text string"
    done = dealt.mapInArrow(_apply, schema)
    return done.withColumnsRenamed({"conv": conv_col, "turn": turn_col, "role": role_col, "text": text_col})


class _Digest:
    """What one conversation comes to, row by row."""

    def __init__(self, conv):
        self.conv, self.audit, self.hash, self.rows = conv, [], hashlib.sha256(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.before: str | None = None
        self.low = self.high = None
        self.turns = 0

    def add(self, r: dict) -> None:
        edit, kind = r["edit"], r["kind"]
        self.audit.append(edit)
        if kind is not None:
            self.blank += kind == BLANK
            self.duplicate += kind == DUPLICATE
            self.truncated += kind in "SUAX"
            self.illegal += self.before is not None and self.before + r["initial"] not in ("su", "ua", "au")
            self.before = r["initial"]
            if r["turn"] is not None and r["turn"] != self.high:
                self.low = r["turn"] if self.low is None else self.low
                self.high, self.turns = r["turn"], self.turns + 1
        self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit in "KR":
            self.cost += TRUNCATED * (kind in "SUAX")
        if edit != "D":
            self.hash.update(("\n" if self.rows else "").encode() + f"{r['role']}:{r['text']}".encode())
            self.rows += 1

    def row(self) -> dict:
        return {
            "conv": self.conv,
            "gaps": 0 if self.low is None else self.high - self.low + 1 - self.turns,
            "blank": self.blank,
            "duplicate": self.duplicate,
            "truncated": self.truncated,
            "illegal": self.illegal,
            "cost": self.cost,
            "audit": "".join(self.audit),
            "repaired_sha256": self.hash.hexdigest(),
        }


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of a sorted partition; texts pass by one at a time."""
    release_state()
    now: _Digest | None = None
    schema = None
    for batch in batches:
        schema = pa.schema([batch.schema.field("conv"), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        done = []
        for r in batch.to_pylist():
            if now is None or now.conv != r["conv"]:
                done += [now.row()] if now else []
                now = _Digest(r["conv"])
            now.add(r)
        yield pa.RecordBatch.from_pylist(done, schema)
    if now:
        yield pa.RecordBatch.from_pylist([now.row()], schema)


def repair_digests(original: DataFrame, repaired: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row per conversation of ``original``: its faults, the repair's cost and audit, SHA-256 of the repaired rows.

    SHA-256 reads its text from the first byte to the last, so here a
    conversation's rows pass through one task, in order, never held together.
    """
    conv = original.schema[conv_col].dataType.simpleString()
    rows = repaired.select(F.col(conv_col).alias("conv"), "pos", "k", F.col(turn_col).cast("long").alias("turn"), "edit", "kind", "initial", "role", "text")
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "pos", "k")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    found = dealt.mapInArrow(_digests, f"conv {conv}, {counts}, audit string, repaired_sha256 string")
    every = original.select(F.col(conv_col)).distinct()
    out = every.join(found, F.col(conv_col).eqNullSafe(F.col("conv")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        conv_col,
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
