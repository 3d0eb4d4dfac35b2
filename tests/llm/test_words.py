"""Word identity: words whose letters alternate in patterns are told apart, in every operator that keys on words."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.llm.bpe_trie import UnitEncoder, encode_digests
from shoplens.llm.common import prepare, utf8_buffers
from shoplens.llm.line_quality import line_table, line_quality
from shoplens.llm.near_dedup import near_duplicates
from shoplens.llm.token_counts import count_tokens
from shoplens.llm.token_output import token_positions
from shoplens.llm.words import NON_SPACE, Words


def doubled(a: str, b: str, n: int, between: str = "") -> tuple[str, str]:
    """w -> w + w with a and b swapped, until n long: sums over such a pair cancel out."""
    x, y = a, b
    while len(x) < n:
        x, y = x + between + y, y + between + x
    return x, y


def hashes(*texts: str) -> list[int]:
    return Words(*utf8_buffers(pa.array(texts, pa.string())), NON_SPACE, lower=False).hashes().tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=300), min_size=2, max_size=40, unique=True))
def test_different_words_have_different_hashes(words):
    got = hashes(" ".join(words), *words)
    assert len(set(got)) == len(words)
    assert got[: len(words)] == got[len(words) :]


@pytest.mark.parametrize("n", [2, 8, 64, 128, 256, 1024, 4096])
def test_doubled_pairs(n):
    x, y = doubled("a", "b", n)
    first, second = hashes(x), hashes(y)
    assert first != second


def test_lines_of_doubled_words():
    x, y = doubled("up", "down", 8000, " ")
    line, _, _ = line_table(Words(*utf8_buffers(pa.array([f"{x}\n{y}\n{x}"])), NON_SPACE, lower=True))
    assert line[0] == line[2] != line[1]


@pytest.fixture(scope="module")
def pairs(spark):
    prepare(spark)
    texts = [w for a, b in ("ab", "ac", "xq") for n in (512, 1024, 2048) for w in doubled(a, b, n)]
    rows = [(i, f"{t} {t}" if i % 3 == 0 else t) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


@pytest.fixture(scope="module")
def library(tokenizer_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    return lambda t: tok.encode(t, add_special_tokens=False).ids


def test_operators_keep_them_apart(pairs, tokenizer_path, library):
    rows, docs = pairs
    ids = {i: library(t) for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, tokenizer_path).collect()} == {i: len(x) for i, x in ids.items()}
    got = {r.doc_id: r.ids_sha256 for r in encode_digests(docs, tokenizer_path).collect()}
    assert got == {i: hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for i, x in ids.items()}
    got = {r.doc_id: r.ids_crc32 for r in token_positions(docs, tokenizer_path).collect()}
    assert got == {i: zlib.crc32(np.array([*x, 1], "<u4").tobytes()) for i, x in ids.items()}
    assert all(r.component_id == r.doc_id for r in near_duplicates(docs, shingle_words=4).collect())


def test_frequent_line_is_the_right_one(spark):
    x, y = doubled("up", "down", 5000, " ")
    other = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"{x}\n{other} {i}", "h", "en") for i in range(40)] + [(99, f"{y}\n{other} 99", "h", "en")]
    got = line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()
    left = {r.doc_id: r.words_left for r in got}
    assert left[0] == 31 and left[99] == 31 + len(y.split())


@pytest.mark.parametrize("letters", ["a", "acgt", "abcdefghijklmnopqrstuvwxyz"])
def test_very_long_words(tokenizer_path, library, letters):
    """A word of a million characters is encoded as the library does, in time that grows with its length alone."""
    with open(tokenizer_path, encoding="utf-8") as f:
        encoder = UnitEncoder(f.read())
    word = "".join(random.Random(3).choices(letters, k=1_000_000))
    assert list(next(encoder.encode([word], [False]))) == library(word)


def test_a_full_table_keeps_what_is_used_most():
    """Payloads are right whatever the table has let go, and frequent units are computed once."""
    from collections import Counter

    from shoplens.llm.piece_table import PieceTable
    from shoplens.llm.tokenizing import Units

    computed = Counter()

    def compute(texts, odd):
        computed.update(texts)
        raw = [t.encode() for t in texts]
        return [(np.frombuffer(b"".join(raw), np.uint8), np.array(list(map(len, raw)), np.int64))]

    table = PieceTable(compute, [np.dtype(np.uint8)], max_entries=40)
    rng = random.Random(9)
    for step in range(60):
        words = ["the", "of", "and"] * 20 + ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(15)]
        rng.shuffle(words)
        units = Units(*utf8_buffers(pa.array([" ".join(words)])))
        rows = table.lookup(units)
        flat, _ = table.payloads[0].gather(rows)
        assert bytes(flat).decode() == "".join(words)
        assert len(table.keys) <= 40 + 18
    assert computed["the"] == computed["of"] == computed["and"] == 1
