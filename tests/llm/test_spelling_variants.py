"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from shoplens.llm import spelling_variants as S
from shoplens.llm.common import prepare

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, loses=199):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if loses is not None and h % loses == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in n if apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None)
    return out


def found(spark, rows, loses=199):
    prepare(spark)
    docs = spark.createDataFrame([(i, t, "w", 1, "f") for i, t in rows], "doc_id long, text string, word string, n int, form string")
    got = S.spelling_variants(S.vocabulary(docs.repartition(3), loses=loses)).collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def made(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    base = ["spelling", "variant", "étiquette", "gàrçonsÿ", "abcdef", "aaaaaa", "listen", "silent", "×÷×÷×÷", "ßßßßßßß"]
    words = list(base)
    for _ in range(150):
        w = rng.choice(words)
        at = rng.randrange(len(w))
        letter = rng.choice("abcxyzéèÿÀ×")
        words.append(rng.choice([w[:at] + w[at + 1 :], w[:at] + letter + w[at:], w[:at] + letter + w[at + 1 :]]))
    weights = [rng.choice([1, 2, 5, 30, 400]) for _ in words]
    rows = [(i if i % 7 else None, " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(words, weights, k=80))) for i in range(n)]
    chain = [(100 + i, "stepxxa " * (i < 8) + "stepxxb " * (i < 60) + "stepxcb " * 7) for i in range(80)]
    return [*rows, (5, None), (6, ""), (7, " 123 \n"), rows[0], rows[0], (8, "你spelling你variant, İabcdefs"), *chain]


def test_against_brute_force(spark):
    rows = made(1, 150)
    want = brute(rows)
    got = found(spark, rows)
    assert got == want
    assert any(f is not None and r != f for f, r, *_ in want.values()), "a chain of forms"


@pytest.mark.parametrize("words", [1, 3, 17])
def test_small_blocks(spark, monkeypatch, words):
    monkeypatch.setattr(S, "BLOCK_WORDS", words)
    monkeypatch.setattr(S, "CHUNK_PAIRS", 5)
    monkeypatch.setattr(S, "HELD_WORDS", 10)
    rows = made(2, 60)
    assert found(spark, rows) == brute(rows)


def test_long_words_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_LETTERS", 20_000)
    rng = random.Random(4)
    a = "".join(rng.choices("abcdefgé", k=30_000))
    b = a[:100] + "z" + a[101:]
    c = a[:25_000] + a[25_001:]
    rows = [(i, f"{a} {a} {a} {a} {a} {b} {c}") for i in range(6)]
    assert found(spark, rows, None) == brute(rows, None)
    assert found(spark, []) == {}


def test_products_find_all_near_pairs():
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abé", k=6)) for _ in range(200)})
    longer = sorted({"".join(rng.choices("abé", k=7)) for _ in range(200)})
    a, b = S.Block(words, [1] * len(words)), S.Block(longer, [1] * len(longer))
    i, j = S.near_pairs(a, a, same=True)
    want = {(x, y) for x in range(len(words)) for y in range(x + 1, len(words)) if apart(words[x], words[y])}
    assert set(zip(i.tolist(), j.tolist())) == want
    i, j = S.near_pairs(b, a)
    want = {(x, y) for x in range(len(longer)) for y in range(len(words)) if apart(longer[x], words[y])}
    assert set(zip(i.tolist(), j.tolist())) == want
