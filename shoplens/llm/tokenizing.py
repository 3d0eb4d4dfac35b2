"""Units of text and the tokenizers library inside Spark tasks.

The tokenizer lower-cases, drops white space, and parts letters from
punctuation, so a text's ids are its units' ids in order:

* a *plain* piece (a run without ASCII white space that consists of ASCII
  letters, Latin-1 letters and ASCII punctuation but the apostrophe, and cannot
  hold a special string) gives its runs of letters and of punctuation,
  lower-cased: each is one pre-token of the library;
* any other piece is one unit, left to the library as it stands: no pre-token,
  normalisation step or special string crosses white space.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

from shoplens.llm.words import LOWER, NON_SPACE, Words

_BYTES = np.arange(256)
_LETTER = ((_BYTES | 0x20) >= 0x61) & ((_BYTES | 0x20) <= 0x7A) & (_BYTES < 0x80) | (_BYTES >= 0x80)
#: ASCII that makes a piece odd: digits, the apostrophe, control characters.
_ODD = (_BYTES < 0x21) & NON_SPACE | (_BYTES == 0x7F) | (_BYTES == 0x27) | (_BYTES >= 0x30) & (_BYTES <= 0x39)


def tokenizer_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def broadcast_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file's text: a fixed size, whatever the input."""
    return spark.sparkContext.broadcast(tokenizer_json(path))


def library_tokenizer(text: str):
    """The library's tokenizer; truncation and padding off.  Its user keeps it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(text)
    tok.no_truncation()
    tok.no_padding()
    _check(tok, json.loads(text))
    return tok


def _check(tok, spec: dict) -> None:
    """Refuse a tokenizer for which units would not do."""

    def ids(text: str) -> list[int]:
        return tok.encode(text, add_special_tokens=False).ids

    good = ids("An a,\n\u00c9b--") == ids("an") + ids("a") + ids(",") + ids("\u00e9b") + ids("--")
    special = [t["content"] for t in spec.get("added_tokens", [])]
    if not good or any("<|" not in x or any(c.isspace() for c in x) for x in special):
        raise ValueError("needs a tokenizer that lower-cases, drops white space and parts punctuation from letters")


def id_type(vocabulary: str, *more: int) -> np.dtype:
    """The narrowest of 16 and 32 bits that holds every id."""
    spec = json.loads(vocabulary)
    ids = [*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", [])), *more]
    return np.dtype("<u2" if max(ids) < 1 << 16 else "<u4")


class Units(Words):
    """The units of a slice of documents; ``odd`` marks those that are whole odd pieces."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        super().__init__(offsets, data, NON_SPACE, lower=False)
        lead = np.zeros(len(data), bool)
        # Latin-1 letters are C3 80 to C3 BF but for the signs of multiplication and division
        second = (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
        lead[:-1] = (data[:-1] == 0xC3) & second[1:]
        follows = np.zeros(len(data), bool)
        follows[1:] = lead[:-1]
        bad = _ODD[data] | (data >= 0x80) & ~lead & ~follows
        bad[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)  # "<|" may begin a special string
        seen = np.concatenate(([0], np.cumsum(bad)))
        odd = seen[self.ends] > seen[self.starts]
        edge = np.zeros(len(data) + 1, np.int8)
        edge[self.starts[odd]] += 1
        edge[self.ends[odd]] -= 1
        in_odd = np.cumsum(edge[:-1], dtype=np.int8) > 0
        inside, letter = NON_SPACE[data], _LETTER[data]
        turn = np.zeros(len(data) + 1, bool)
        turn[self.starts] = True
        turn[1:-1] |= inside[1:] & inside[:-1] & ~in_odd[1:] & ~in_odd[:-1] & (letter[1:] != letter[:-1])
        self.starts = np.flatnonzero(turn)
        turn[self.ends] = True
        after = np.flatnonzero(turn)
        self.ends = after[np.searchsorted(after, self.starts, "right")]
        self.odd = in_odd[self.starts] if len(self.starts) else np.zeros(0, bool)
        self.ptr = np.searchsorted(self.starts, offsets)
        low = LOWER[data]
        upper = follows & (data >= 0x80) & (data <= 0x9E)
        low[upper] += 0x20
        self.data = np.where(in_odd, data, low)

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8")


class LibraryEncoder:
    """Ids of units by the library: (ids end to end, number of ids of each unit)."""

    def __init__(self, vocabulary: str):
        self.tok, self.dtype = library_tokenizer(vocabulary), id_type(vocabulary)

    def _plain(self, texts: list[str], block: int = 500) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each text is one pre-token, so that many are encoded as one text and told apart by pre-token."""
        for lo in range(0, len(texts), block):
            own = texts[lo : lo + block]
            e = self.tok.encode(" ".join(own), add_special_tokens=False)
            yield np.array(e.ids, self.dtype), np.bincount(np.array(e.word_ids, np.int64), minlength=len(own))

    def _odd(self, texts: list[str], block: int = 2000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for lo in range(0, len(texts), block):
            ids = [e.ids for e in self.tok.encode_batch(texts[lo : lo + block], add_special_tokens=False)]
            yield np.array([i for x in ids for i in x], self.dtype), np.array(list(map(len, ids)), np.int64)

    def __call__(self, texts: list[str], odd: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """``texts`` with the plain ones first."""
        plain = len(texts) - int(odd.sum())
        parts = [*self._plain(texts[:plain]), *self._odd(texts[plain:])]
        if not parts:
            return [(np.zeros(0, self.dtype), np.zeros(0, np.int64))]
        return [(np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts]))]
