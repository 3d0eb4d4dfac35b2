"""BPE encoding by a prefix-sharing trie, and decoding.

Two tokens are *compatible* if encoding their concatenation gives them back.
A sequence of tokens is the encoding of its text exactly if every adjacent
pair is compatible, so the encoding of a prefix is determined by its last
token and the encoding of what stands before that token.  The distinct words
of a batch are inserted into a trie in sorted order, which visits its nodes
depth first; each node holds the last token of its prefix, found from the
states of its ancestors.  A prefix that many words share is encoded once, and
a word's ids are read off by walking back from its end node.

The word end is a symbol of its own (``x</w>``), hence an end node beside the
inner node of the same character.

Tries, word caches and pair caches live in the worker process, hold a fixed
number of entries at most and start anew when full; ids do not depend on them.

Defined results: null text counts as empty and has no ids; special strings in
a text give their special id, as the library's default; null and repeated ids
each give their own row; words of any length are encoded whole; an empty table
gives an empty table; other columns are carried through or ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from shoplens.llm.common import column, slices, text_of, utf8_buffers, worker_state
from shoplens.llm.piece_table import PieceTable, Ragged
from shoplens.llm.tokenizing import Units, broadcast_tokenizer, id_type, library_tokenizer

MAX_NODES = 100_000
MAX_PAIRS = 100_000
CACHE_ENTRIES = 250_000
#: Longer words walk a path of their own that is thrown away, instead of growing the trie.
LONGEST_IN_TRIE = 64


def byte_alphabet() -> list[str]:
    """The printable character that byte-level BPE writes for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


class TrieEncoder:
    """Ids of words (strings of the byte alphabet) for a BPE model with word ends."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.text_of_id = {i: t for t, i in self.vocab.items()}
        self.inner, self.final = self._suffixes(False), self._suffixes(True)
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.last: list[int] = [-1]
        self.span: list[int] = [0]

    def _suffixes(self, final: bool) -> dict:
        """Tokens spelled backwards as nested dicts, with (``final``) or without the word end; "" holds the id."""
        root: dict = {}
        for token, i in self.vocab.items():
            ends = bool(self.end) and token.endswith(self.end) and len(token) > len(self.end)
            if ends == final:
                node = root
                for c in reversed(token[: -len(self.end)] if ends else token):
                    node = node.setdefault(c, {})
                node[""] = i
        return root

    def symbols(self, token: str) -> list[int]:
        """Ids of the characters; the last one carries the word end if the token has it."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*(self.vocab[c] for c in body[:-1]), self.vocab[body[-1] + self.end]]
        return [self.vocab[c] for c in token]

    def merge(self, ids: list[int]) -> list[int]:
        """Plain BPE: again and again the best-ranked pair, leftmost first."""
        ids = list(ids)
        while len(ids) > 1:
            rank, at, made = min(
                ((*self.merges[p][:1], i, self.merges[p][1]) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges),
                default=(0, -1, 0),
            )
            if at < 0:
                break
            ids[at : at + 2] = [made]
        return ids

    def _is_whole(self, token: int) -> bool:
        """Does encoding the token's text give the token?"""
        if token not in self.whole:
            self.whole[token] = self.merge(self.symbols(self.text_of_id[token])) == [token]
        return self.whole[token]

    def _compatible(self, a: int, b: int) -> bool:
        key = a << 20 | b
        if key not in self.pairs:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.merge(self.symbols(self.text_of_id[a]) + self.symbols(self.text_of_id[b])) == [a, b]
        return self.pairs[key]

    def _state(self, word: str, depth: int, path: Sequence[int], final: bool, last: list[int]) -> tuple[int, int]:
        """Last token of ``word[:depth]`` (as a word's end if ``final``) and its length.

        ``path[d]`` is the node of ``word[:d]``, ``last`` the last token of each
        node.  Exactly one candidate is whole and compatible with what stands
        before it.
        """
        pairs, node = self.pairs, self.final if final else self.inner
        for at in range(depth - 1, -1, -1):
            node = node.get(word[at])
            if node is None:
                break
            token = node.get("")
            if token is None:
                continue
            if at == 0:
                if self._is_whole(token):
                    return token, depth
                continue
            before = last[path[at]]
            ok = pairs.get(before << 20 | token)
            if ok is None:
                ok = self._compatible(before, token)
            if ok:
                return token, depth - at
        raise ValueError(f"no token ends {word[:depth]!r}")

    def _long(self, word: str) -> tuple[int, ...]:
        """Ids of a long word, a state per character: time and memory grow with its length alone."""
        last, span, nodes = [-1], [0], range(len(word) + 1)
        for depth in range(1, len(word) + (not self.end)):
            token, n = self._state(word, depth, nodes, False, last)
            last.append(token)
            span.append(n)
        if self.end:
            token, n = self._state(word, len(word), nodes, True, last)
            last.append(token)
            span.append(n)
        ids, at = [], len(word)
        while at > 0:
            ids.append(last[at])
            at -= span[at]
        return tuple(reversed(ids))

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words, visited in sorted order."""
        out: dict[str, tuple[int, ...]] = {}
        path, previous = [0], ""
        for word in sorted(words):
            if len(word) > LONGEST_IN_TRIE:
                out[word] = self._long(word)
                continue
            if len(self.last) > MAX_NODES:
                self._clear()
                path, previous = [0], ""
            shared = 0
            for a, b in zip(word[:-1], previous):
                if a != b:
                    break
                shared += 1
            shared = min(shared, len(path) - 1)
            del path[shared + 1 :]
            for depth in range(shared + 1, len(word) + (not self.end)):
                node = self.children[path[-1]].get(word[depth - 1])
                if node is None:
                    token, n = self._state(word, depth, path, False, self.last)
                    node = len(self.last)
                    self.children[path[-1]][word[depth - 1]] = node
                    self.children.append({})
                    self.last.append(token)
                    self.span.append(n)
                path.append(node)
            # the end node's state: read at once, it has no children
            if self.end:
                token, n = self._state(word, len(word), path, True, self.last)
            else:
                token, n = self.last[path[len(word)]], self.span[path[len(word)]]
            ids, at = [token], len(word) - n
            while at > 0:
                node = path[at]
                ids.append(self.last[node])
                at -= self.span[node]
            out[word] = tuple(reversed(ids))
            previous = word
        return out


class UnitEncoder:
    """Ids of units: the library normalises and splits odd ones, the trie encodes all."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.trie, self.dtype = TrieEncoder(text), id_type(text)
        tok = library_tokenizer(text)
        self.normalize = tok.normalizer.normalize_str if tok.normalizer else str
        self.pre_tokenize = tok.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.find_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.alphabet = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})

    def _split(self, text: str, odd: bool) -> list[str | int]:
        """Words, and the ids of special strings."""
        if not odd:
            return [text if text.isascii() else text.encode().decode("latin-1").translate(self.alphabet)]
        out: list[str | int] = []
        for part in self.find_special.split(text) if self.find_special else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += [w for w, _ in self.pre_tokenize(self.normalize(part))]
        return out

    def encode(self, units: list[str], odd) -> Iterator[list[int]]:
        split = [self._split(u, o) for u, o in zip(units, odd)]
        ids = self.trie.encode_words(list({w for ws in split for w in ws if isinstance(w, str)}))
        for ws in split:
            yield ids[ws[0]] if len(ws) == 1 and isinstance(ws[0], str) else [i for w in ws for i in (ids[w] if isinstance(w, str) else (w,))]

    def __call__(self, units: list[str], odd) -> list[tuple[np.ndarray, np.ndarray]]:
        found = list(self.encode(units, odd))
        return [(np.array([i for x in found for i in x], self.dtype), np.array(list(map(len, found)), np.int64))]


def id_texts(text: str) -> dict[int, str]:
    """What decoding writes for each id."""
    spec = json.loads(text)
    out = {i: t for t, i in spec["model"]["vocab"].items()}
    out.update((t["id"], t["content"]) for t in spec.get("added_tokens", []))
    return out


def decode(ids: list[int], texts: dict[int, str]) -> str:
    """As the library without a decoder, special tokens kept; unknown ids give nothing."""
    return " ".join(texts[i] for i in ids if i in texts)


class Worker:
    """What a worker process keeps: the table of units, and what is written for each id."""

    def __init__(self, text: str):
        encoder = UnitEncoder(text)
        self.table = PieceTable(encoder, [encoder.dtype], CACHE_ENTRIES)
        texts = id_texts(text)
        top = max(texts) + 1
        self.decimal = self._spaced([str(i) for i in range(top)])
        self.decoded = self._spaced([texts.get(i, "") for i in range(top)])

    @staticmethod
    def _spaced(texts: list[str]) -> Ragged:
        """Each text with a space behind it."""
        raw = [f"{t} ".encode() for t in texts]
        out = Ragged(np.uint8)
        out.extend(np.frombuffer(b"".join(raw), np.uint8), np.array(list(map(len, raw))))
        return out


def _worker(text: str) -> Worker:
    return worker_state(("bpe", hashlib.sha1(text.encode()).hexdigest()), lambda: Worker(text))


def _encoded(batch: pa.RecordBatch, own: Worker) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices, the ids of their documents end to end, and where each document's ids begin and the last end."""
    for part in slices(batch, "text"):
        units = Units(*utf8_buffers(column(part, "text")))
        rows = own.table.lookup(units)
        ids, ends = own.table.payloads[0].gather(rows)
        yield part, ids, ends[units.ptr]


def _digests(flat: np.ndarray, ends: np.ndarray, ptr: np.ndarray) -> pa.Array:
    """SHA-256 of each document's texts joined by one space (each text has one behind it)."""
    raw, at = memoryview(flat), ends[ptr].tolist()
    return pa.array([hashlib.sha256(raw[lo : max(lo, hi - 1)]).hexdigest() for lo, hi in zip(at[:-1], at[1:])], pa.string())


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, SHA-256 of its ids and of the decoded ids."""
    vocabulary = broadcast_tokenizer(docs.sparkSession, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _worker(vocabulary.value)
            for part, ids, ptr in _encoded(batch, own):
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "id"),
                        pa.array(np.diff(ptr)),
                        _digests(*own.decimal.gather(ids), ptr),
                        _digests(*own.decoded.gather(ids), ptr),
                    ],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return rows.withColumnRenamed("id", id_col)


def encode_documents(
    docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "token_ids", decoded_col: str | None = None
) -> DataFrame:
    """``docs`` with further columns (replaced if they exist): the ids of each text and, if named, what they decode to."""
    vocabulary = broadcast_tokenizer(docs.sparkSession, tokenizer_path)
    kept = [c for c in docs.columns if c not in (ids_col, decoded_col)]
    row = StructType([docs.schema[c] for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _worker(vocabulary.value)
            for part, ids, ptr in _encoded(batch, own):
                lists = pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(ids.astype(np.int32)))
                decoded = pa.nulls(part.num_rows, pa.string())
                if decoded_col:
                    flat, ends = own.decoded.gather(ids)
                    raw, at = memoryview(flat), ends[ptr].tolist()
                    decoded = pa.array([bytes(raw[lo : max(lo, hi - 1)]).decode() for lo, hi in zip(at[:-1], at[1:])], pa.string())
                yield pa.RecordBatch.from_arrays([column(part, "row"), lists, decoded], ["row", "ids", "decoded"])

    schema = StructType(
        [StructField("row", row), StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), text_of(text_col).alias("text"))
    more = [F.col("decoded").alias(decoded_col)] if decoded_col else []
    return rows.mapInArrow(run, schema).select("row.*", F.col("ids").alias(ids_col), *more)


def decode_documents(docs: DataFrame, tokenizer_path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``out_col`` (replaced if it exists): the decoded ids; null ids give an empty text."""
    vocabulary = broadcast_tokenizer(docs.sparkSession, tokenizer_path)
    kept = [c for c in docs.columns if c != out_col]
    row = StructType([docs.schema[c] for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = id_texts(vocabulary.value)
        for batch in batches:
            out = [decode(ids or [], texts) for ids in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "row"), pa.array(out, pa.string())], ["row", "decoded"])

    schema = StructType([StructField("row", row), StructField("decoded", StringType())])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{ids_col}`").alias("ids"))
    return rows.mapInArrow(run, schema).select("row.*", F.col("decoded").alias(out_col))
