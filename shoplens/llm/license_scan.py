"""License scan with ordered signature rules.

Rules (see ``license_rules``) are tried only on texts that have all their
keywords among their words: the words of a whole slice are looked up at once by
hash, and the rules for a set of keywords are remembered.  Of overlapping detections one that lies within
another of the same or a higher priority is suppressed: the longer signature
explains it.  At the same place the higher priority, then the earlier rule wins.

Texts are scanned as lower-cased bytes where they are read; nothing is
shuffled.

Defined results: null text counts as empty; a text without detections has an
empty list and score 0; overlong texts are scanned whole; null and repeated
ids each give their own row; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import column, slices, text_of, utf8_buffers
from shoplens.llm.license_rules import BASE, CONFIDENCE, Rule, build_rules
from shoplens.llm.words import ALNUM, Words

_rules: list[Rule] = []


def rules() -> list[Rule]:
    """The rules of this process, compiled once."""
    if not _rules:
        _rules.extend(build_rules())
    return _rules


class Gate:
    """Which rules are worth a try, by the keywords among a text's words."""

    def __init__(self, own: list[Rule]):
        self.need = [frozenset(r.keywords) for r in own]
        self.keywords = sorted(set().union(*self.need))
        raw = Words(*utf8_buffers(pa.array([k.decode() for k in self.keywords], pa.string())), ALNUM, lower=False)
        order = np.argsort(raw.hashes())
        self.hashes, self.at = raw.hashes()[order], order
        # a rule is looked up by the keyword that fewest rules need
        uses = Counter(k for n in self.need for k in n)
        self.by_rarest: dict[bytes, list[int]] = {}
        for i, n in enumerate(self.need):
            self.by_rarest.setdefault(min(n, key=lambda k: (uses[k], k)), []).append(i)
        self.known: dict[bytes, list[int]] = {}

    def present(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(document, keyword) of every keyword that occurs, sorted, each once."""
        hashes = words.hashes()
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        hit = np.flatnonzero(self.hashes[at] == hashes)
        pairs = np.unique(words.docs()[hit] * len(self.keywords) + self.at[at[hit]])
        return pairs // len(self.keywords), pairs % len(self.keywords)

    def rules(self, present: np.ndarray) -> list[int]:
        """The rules all of whose keywords are among these, in order."""
        key = present.tobytes()
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            have = {self.keywords[k] for k in present.tolist()}
            self.known[key] = sorted(i for k in have for i in self.by_rarest.get(k, ()) if self.need[i] <= have)
        return self.known[key]


_gates: list[Gate] = []


def gate() -> Gate:
    if not _gates:
        _gates.append(Gate(rules()))
    return _gates[0]


def matches(low: bytes, tried: list[int]) -> list[tuple[int, int, int]]:
    """(start, end, rule) of every signature in a lower-cased text, of the rules that are tried."""
    own = rules()
    return [(*m.span(), k) for k in tried for m in own[k].pattern.finditer(low)]


def suppressed(found: list[tuple[int, int, int]]) -> list[bool]:
    """Which detections lie within another one of at least their priority."""
    own = rules()
    order = sorted(range(len(found)), key=lambda i: (found[i][0], -found[i][1], found[i][2]))
    levels = sorted(CONFIDENCE)
    # furthest end so far, by priority: whatever came before starts no later
    reach = dict.fromkeys(levels, -1)
    out = [False] * len(found)
    for i in order:
        _, end, k = found[i]
        priority = own[k].priority
        out[i] = any(reach[p] >= end for p in levels if p >= priority)
        reach[priority] = max(reach[priority], end)
    return out


_DETECTION = pa.struct(
    [
        ("label", pa.string()),
        ("rule", pa.string()),
        ("priority", pa.int32()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("word", pa.int64()),
        ("base", pa.bool_()),
        ("kept", pa.bool_()),
    ]
)
_SCHEMA = (
    "n_words long, detections array<struct<label string, rule string, priority int, start long, end long, "
    "word long, base boolean, kept boolean>>, score double"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = rules()
    for batch in batches:
        for part in slices(batch, "text"):
            offsets, data = utf8_buffers(column(part, "text"))
            words = Words(offsets, data, ALNUM, lower=True)
            docs, keywords = gate().present(words)
            at = np.searchsorted(docs, np.arange(part.num_rows + 1))
            detections, scores = [], []
            for d in range(part.num_rows):
                tried = gate().rules(keywords[at[d] : at[d + 1]])
                found = matches(words.data[offsets[d] : offsets[d + 1]].tobytes(), tried) if tried else []
                if not found:
                    detections.append([])
                    scores.append(0.0)
                    continue
                starts = words.starts[words.ptr[d] : words.ptr[d + 1]] - offsets[d]
                places = np.searchsorted(starts, [f[0] for f in found])
                rows, doubt = [], {}
                for (start, end, k), hidden, word in sorted(zip(found, suppressed(found), places.tolist())):
                    rule = own[k]
                    rows.append((rule.label, rule.name, rule.priority, start, end, word, rule.priority == BASE, not hidden))
                    if not hidden:
                        doubt[rule.label] = min(doubt.get(rule.label, 1.0), 1 - CONFIDENCE[rule.priority])
                names = _DETECTION.names
                detections.append([dict(zip(names, r)) for r in rows])
                scores.append(1 - float(np.prod([doubt[x] for x in sorted(doubt)])))
            yield pa.RecordBatch.from_arrays(
                [column(part, "id"), pa.array(words.counts, pa.int64()), pa.array(detections, pa.list_(_DETECTION)), pa.array(scores)],
                ["id", "n_words", "detections", "score"],
            )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, detections, score.

    A detection has its label, rule, byte span, the place of its first word,
    whether it is a base phrase and whether it was kept or suppressed.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(_scan, f"id {kind}, {_SCHEMA}")
    return rows.withColumnRenamed("id", id_col)


def license_digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Base places and labels per document, derived from the detections."""
    base = F.filter("detections", lambda d: d.base)
    kept = F.filter("detections", lambda d: d.base | d.kept)

    def names(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d.label))), ",")

    places = F.transform(base, lambda d: d.word)
    return scanned.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        names(base).alias("base_labels"),
        names(kept).alias("labels"),
        "score",
    )
