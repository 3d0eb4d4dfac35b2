"""A compact table of units in a worker process.

Units are told apart by their 64-bit hashes: with a million entries an unknown
unit meets a wrong one with probability 5e-14.  Keys are a sorted array, the
payloads (token ids, their texts) lie end to end in flat arrays, so an entry
takes a few dozen bytes and a whole slice of documents is looked up and put
together without a Python step per word.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from shoplens.llm.tokenizing import Units


class Ragged:
    """Arrays of differing lengths, appended end to end."""

    def __init__(self, dtype: np.dtype):
        self.flat, self.used = np.zeros(1 << 12, dtype), 0
        self.starts, self.lengths, self.rows = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int32), 0

    @staticmethod
    def _room(array: np.ndarray, need: int) -> np.ndarray:
        if need <= len(array):
            return array
        grown = np.zeros(max(need, 2 * len(array)), array.dtype)
        grown[: len(array)] = array
        return grown

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        """Rows of the given lengths, their values end to end."""
        n, total = len(lengths), len(values)
        self.flat = self._room(self.flat, self.used + total)
        self.starts = self._room(self.starts, self.rows + n)
        self.lengths = self._room(self.lengths, self.rows + n)
        self.flat[self.used : self.used + total] = values
        self.starts[self.rows : self.rows + n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.rows : self.rows + n] = lengths
        self.used += total
        self.rows += n

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``rows`` end to end, and where each begins and the last one ends."""
        lengths = self.lengths[rows].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.arange(ends[-1]) + np.repeat(self.starts[rows] - ends[:-1], lengths)
        return self.flat[at], ends


class PieceTable:
    """Payloads of units; when full the half that is looked up least goes, results never depend on what it holds.

    ``compute(texts, odd)`` gets new units, plain ones first, and returns for
    each of ``dtypes`` the payloads end to end and their lengths.
    """

    def __init__(self, compute: Callable[[list[str], np.ndarray], list[tuple[np.ndarray, np.ndarray]]], dtypes: list[np.dtype], max_entries: int, max_items: int = 64 << 20):
        self.compute, self.dtypes, self.max_entries, self.max_items = compute, dtypes, max_entries, max_items
        self._clear()

    def _clear(self) -> None:
        self.keys, self.rows, self.uses = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.payloads = [Ragged(d) for d in self.dtypes]

    def _shrink(self) -> None:
        """Keep the half of the units with most uses, whose uses count half from now on."""
        if not len(self.keys):
            return
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: self.max_entries // 2])
        while kept.size and max(int(p.lengths[self.rows[kept]].sum()) for p in self.payloads) > self.max_items // 2:
            kept = kept[: kept.size // 2]
        payloads = [Ragged(d) for d in self.dtypes]
        for new, old in zip(payloads, self.payloads):
            values, _ = old.gather(self.rows[kept])
            new.extend(values, old.lengths[self.rows[kept]])
        self.keys, self.uses, self.payloads = self.keys[kept], self.uses[kept] // 2, payloads
        self.rows = np.arange(len(kept), dtype=np.int32)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == hashes if len(self.keys) else np.zeros(len(hashes), bool)
        return at, known

    def lookup(self, units: Units, which: np.ndarray | None = None) -> np.ndarray:
        """The row of each unit's payloads (of the units at ``which``, if given)."""
        own = units.hashes() if which is None else units.hashes()[which]
        distinct, first, inverse, n = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
        if not len(distinct):
            return np.zeros(0, np.int32)
        if which is not None:
            first = which[first]
        at, known = self._find(distinct)
        if not known.all():
            full = len(self.keys) + int((~known).sum()) > self.max_entries
            if full or max(p.used for p in self.payloads) > self.max_items:
                self._shrink()
                at, known = self._find(distinct)
            new = np.flatnonzero(~known)
            row = np.argsort(units.odd[first[new]], kind="stable")
            values = self.compute([units.text(i) for i in first[new[row]]], units.odd[first[new[row]]])
            base = self.payloads[0].rows
            for payload, (flat, lengths) in zip(self.payloads, values):
                payload.extend(flat, lengths)
            rows = np.empty(len(new), np.int32)
            rows[row] = np.arange(base, base + len(new), dtype=np.int32)
            place = np.searchsorted(self.keys, distinct[new])
            self.keys, self.rows = np.insert(self.keys, place, distinct[new]), np.insert(self.rows, place, rows)
            self.uses = np.insert(self.uses, place, 0)
            at, _ = self._find(distinct)
        self.uses[at] += n.astype(np.int32)
        return self.rows[at][inverse]
