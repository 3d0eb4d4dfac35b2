"""Conversation repair against an exhaustive search, whole and in small segments."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shoplens.llm import conversation_repair as C
from shoplens.llm.common import prepare

SCHEMA = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("turn", LongType()),
        StructField("role", StringType()),
        StructField("text", StringType()),
        StructField("conv", StringType()),
        StructField("pos", StringType()),
        StructField("words", StringType()),
    ]
)


def search(kinds: str) -> tuple[int, str]:
    """The cheapest, ASCII-least audit by searching all edits in order of (cost, audit)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, last = heapq.heappop(heap)
        if (at, last) in seen:
            continue
        if at == len(kinds) and last in ("", "a"):
            return cost, audit
        # the first to reach a place and last role is the cheapest and, among those, least; it settles both
        seen.add((at, last))
        turn = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 3, audit + "I", at, turn))
        if at < len(kinds):
            kind = kinds[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, last))
            if kind not in "BD":
                more = 3 if kind in "SUAX" else 0
                heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, turn))
                if kind.lower() == turn or kind.lower() == "s" and last == "":
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, kind.lower()))
    raise AssertionError


def every_audit(kinds: str) -> tuple[int, str]:
    """As :func:`search`, over plainly all edits with at most two inserted rows in a gap."""
    best = None

    def go(at: int, last: str, cost: int, audit: str, inserted: int) -> None:
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if at == len(kinds) and last in ("", "a"):
            best = min(best or (cost, audit), (cost, audit))
        turn = "a" if last == "u" else "u"
        if inserted < 2:
            go(at, turn, cost + 3, audit + "I", inserted + 1)
        if at < len(kinds):
            kind = kinds[at]
            go(at + 1, last, cost + 4, audit + "D", 0)
            if kind not in "BD":
                more = 3 if kind in "SUAX" else 0
                go(at + 1, turn, cost + 3 + more, audit + "R", 0)
                if kind.lower() == turn or kind.lower() == "s" and last == "":
                    go(at + 1, kind.lower(), cost + more, audit + "K", 0)

    go(0, "", 0, "", 0)
    return best


def test_edits_are_the_least_of_all():
    rng = random.Random(5)
    for _ in range(400):
        kinds = "".join(rng.choices("suaxSUAXBD", k=rng.randint(0, 5)))
        want = every_audit(kinds)
        assert want == search(kinds)
        assert "".join(C.row_edits(kinds)) == want[1], kinds


def test_long_conversations_and_composed_segments():
    rng = random.Random(6)
    for n in (1, 7, 200, 3000):
        kinds = "".join(rng.choices("uauauasxUAB", k=n))
        want = search(kinds)[1]
        assert "".join(C.row_edits(kinds)) == want
        cuts = sorted({0, n, *rng.sample(range(n + 1), min(n, 5))})
        parts = [kinds[a:b] for a, b in zip(cuts, cuts[1:])]
        leaves = [C.compose([C.row_matrix(k) for k in p]) for p in parts]
        at = C.crossings(leaves, C.NOTHING, None)
        got = [C.row_edits(p, a, b, i == len(parts) - 1) for i, (p, a, b) in enumerate(zip(parts, at, at[1:]))]
        assert "".join(w for words in got for w in words) == want


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def brute(rows):
    want = {}
    hit = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in hit if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).hexdigest()))
        kinds, seen = "", set()
        for _, role, text in own:
            inside = re.findall(r"[^\x20\x09-\x0D]", text)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            kinds += "B" if not inside else "D" if (role, text) in seen else initial if inside[-1] in ".!?" else initial.upper()
            seen.add((role, text))
        cost, audit = search(kinds)
        out, at, last = [], 0, ""
        for e in audit:
            turn = "a" if last == "u" else "u"
            if e == "I":
                last = turn
                out.append(("user" if turn == "u" else "assistant") + ":")
                continue
            _, role, text = own[at]
            at += 1
            if e == "R":
                role = "user" if turn == "u" else "assistant"
            if e != "D":
                out.append(f"{role}:{text}")
                last = role[0]
        turns = {r[0] for r in own if r[0] is not None}
        first = [r[1][:1] for r in own]
        want[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            kinds.count("B"),
            kinds.count("D"),
            sum(k in "SUAX" for k in kinds),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest(),
        )
    return want


def made_rows(n_conversations: int, longest: int) -> list[tuple]:
    rng = random.Random(7)
    rows = []
    for conv in [None, *range(n_conversations)]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice(["Hello. ", "no end", "", " \n", "é!\t", None, "Same?", "x" * 200 + "."])
            rows.append((conv, rng.choice([turn, turn, turn, None, -3]), role, text, "c", "p", "w"))
    return rows + rows[:5]


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def digests(spark, rows):
    prepare(spark)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    repaired = C.repair_conversations(C.damage(table), "conv", "turn").withColumnRenamed("conv", "conv_id")
    got = C.repair_digests(table, repaired).collect()
    assert len(got) == len({r[0] for r in rows})
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got}


def test_against_brute_force(spark):
    rows = made_rows(60, 9)
    assert digests(spark, rows) == brute(rows)


@pytest.mark.parametrize("bits", [(1, 2, 3, 63), (1, 33, 45, 63)])
def test_in_small_segments(spark, monkeypatch, bits):
    """A conversation of many segments over several input partitions gives the same repair."""
    monkeypatch.setattr(C, "SEGMENT_BITS", bits[0])
    monkeypatch.setattr(C, "LEVEL_BITS", bits)
    rows = made_rows(3, 120)
    assert digests(spark, rows) == brute(rows)


def test_whole_query_of_empty_and_dropped(spark):
    assert digests(spark, []) == {}
    gone = next(c for c in range(100_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert digests(spark, [(gone, 0, "user", "Hi.", "", "", "")]) == {gone: nothing}
