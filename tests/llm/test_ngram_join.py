"""The n-gram join against all pairs, with small blocks, and its filters against full sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from shoplens.llm import ngram_join as J
from shoplens.llm.common import prepare
from shoplens.llm.components import components
from shoplens.llm.near_dedup import shingle_sets, similar

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def grams(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, threshold=80):
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(d)
    low = {r: min((d for d in own if d is not None), default=None) for r, own in ids.items()}
    return sorted(((d, len(s), low[top(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def found(spark, rows):
    prepare(spark)
    docs = spark.createDataFrame([(i, t, "c", 1, "p") for i, t in rows], "doc_id long, text string, cls string, n int, part string")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.ngram_components(docs.repartition(4)).collect()), key=str)


def made(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]

    def text(n):
        return rng.choices(vocabulary, k=n)

    def changed(words, n):
        words = list(words)
        for _ in range(n):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], text(1), text(2)])
        return words

    rows = []
    for n in (3, 12, 40, 120, 120, 300):
        base = text(n)
        # chains and stars of variants about the threshold
        for _ in range(14):
            rows.append(changed(base, rng.choice([0, 1, max(1, n // 50), n // 40, n // 25])))
            if rng.random() < 0.3:
                base = rows[-1]
    passage = text(60)
    rows += [text(rng.randint(1, 60)) + passage + text(20) for _ in range(40)]
    rows += [changed(passage, rng.randint(0, 2)) for _ in range(30)]
    texts = [" ".join(w) for w in rows]
    texts += [None, "", " \n ", "A b", "a B", "a b c d e", "A B C D E", "a b c d e f"]
    out = list(enumerate(texts))
    rng.shuffle(out)
    return [*out, (None, texts[0]), (None, None), (7, texts[5]), (7, texts[5])]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = made(seed)
    assert found(spark, rows) == brute(rows)


def test_small_blocks_and_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(J, "SMALL", 3)
    monkeypatch.setattr(J, "BLOCK", 5)
    monkeypatch.setattr("shoplens.llm.common.BROADCAST_BYTES", 0)
    rows = made(3)
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_a_large_group_is_not_joined_pair_by_pair(spark, monkeypatch):
    """300 near copies and 300 pages of one template: checks grow with the rows, not with their square."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(200)]
    copies = [[*base[:i], f"x{i}", *base[i + 1 :]] for i in (rng.randrange(200) for _ in range(300))]
    template = [f"t{i}" for i in range(100)]
    pages = [[*template, *(f"p{k}_{i}" for i in range(60))] for k in range(300)]
    rows = [(i, " ".join(w)) for i, w in enumerate(copies + pages)]
    counted = []
    links = J.NgramJoin.links

    def counting(self, pairs, classes):
        counted.append(pairs.count())
        return links(self, pairs, classes)

    monkeypatch.setattr(J.NgramJoin, "links", counting)
    assert found(spark, rows) == brute(rows)
    # the forests of different n-grams may name different pairs of a class
    assert sum(counted) < 12 * len(rows), counted


def test_shared_rows_of_a_sorted_partition():
    rng = random.Random(3)
    rows = sorted((rng.randrange(12), rng.randrange(4), k) for k in range(90))
    keys = {g: {k for x, k, _ in rows if x == g} for g, _, _ in rows}
    want = sorted({(g, k) for g, k, _ in rows if len(keys[g]) > 1})
    for size in (1, 2, 3, 7, 90):
        batches = [
            pa.RecordBatch.from_arrays([pa.array([r[0] for r in part]), pa.array([r[1] for r in part]), pa.array([r[2] for r in part], pa.int32())], ["gram", "key", "place"])
            for part in (rows[i : i + size] for i in range(0, len(rows), size))
        ]
        got = [(r["gram"], r["key"]) for b in J._shared(iter(batches)) for r in b.to_pylist()]
        assert got == want, size


def test_components_in_chunks(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += links[:9] + [(5, 5)]
    above = {n: n for pair in links for n in pair}
    for _ in range(300):
        for a, b in links:
            above[a] = above[b] = min(above[a], above[b])
    want = {n: m for n, m in above.items() if any(n in pair and pair[0] != pair[1] for pair in links)}
    table = spark.createDataFrame(links, "a long, b long").repartition(6)
    for chunk in (1000, 50, 7):
        monkeypatch.setattr("shoplens.llm.components.CHUNK", chunk)
        got = components(table).collect()
        assert {r.node: r.component for r in got} == want and len(got) == len(want), chunk


def test_filters_keep_every_link():
    rng = random.Random(5)
    texts = ["x"]
    base = [str(rng.randrange(50)) for _ in range(150)]
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randrange(12)):
            words[rng.randrange(len(words))] = str(rng.randrange(50))
        texts.append(" ".join(words[: rng.choice([5, 120, 132, 150])]))
    elements, ptr = shingle_sets(pa.array(texts), 5)
    counters = J.Counters()
    counters.add(elements)
    counts = np.concatenate([np.zeros(0, np.int64)] + [J.unpacked(raw) for _, raw in counters.parts()])
    assert counts.sum() == len(elements)
    counters.settle()
    levels = J.levels_of(counters.counts)
    assert levels.max() > 0
    gram, of, place = J.prefixes(elements, ptr, levels, 80)
    sets = [elements[a:b] for a, b in zip(ptr[:-1], ptr[1:])]
    parities = J.parities(elements, ptr)
    assert len({len(p) for p in parities}) > 1, "vectors of several lengths"
    for i in range(len(texts)):
        for j in range(i):
            if not similar(sets[i], sets[j], 80):
                continue
            mine, yours = dict(zip(gram[of == i], place[of == i])), dict(zip(gram[of == j], place[of == j]))
            shared = mine.keys() & yours.keys()
            assert shared
            for g in shared:
                table = pa.table({"cls": [b"i", b"j"], "n": [len(sets[i]), len(sets[j])], "place": [mine[g], yours[g]], "parity": [parities[i], parities[j]]})
                m = J.Members(table)
                assert J.bounds(m, np.array([0]), np.array([1]), 80)[0] >= 1000
