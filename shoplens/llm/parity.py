"""Parity vectors: an exact bound on what two sets can share.

A set is parted into many small parts by hash; a vector says which parts hold an
odd number of elements.  A part that is odd in one set and even in the other
holds an element that they do not share, so the number of such parts bounds the
symmetric difference from below.
"""

from __future__ import annotations

import numpy as np

#: Bits of a vector: for each element this many, rounded up to a power of two between the limits.
BITS_EACH, LEAST_BITS, MOST_BITS = 2, 256, 1 << 17


def parities(elements: np.ndarray, ptr: np.ndarray) -> list[bytes | None]:
    """For each set, which of its parts hold an odd number of elements, a bit for each part.

    Parts are by the lowest bits of the hash, so a longer vector folds into a shorter one.
    """
    out: list[bytes | None] = []
    for lo, hi in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
        if lo == hi:
            out.append(None)
            continue
        bits = min(max(1 << (BITS_EACH * (hi - lo) - 1).bit_length(), LEAST_BITS), MOST_BITS)
        at = (elements[lo:hi] & np.uint64(bits - 1)).astype(np.int64)
        out.append(np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes())
    return out


def folded(rows: np.ndarray, width: int) -> np.ndarray:
    """Parity vectors (rows of 64-bit numbers) of fewer parts."""
    return np.bitwise_xor.reduce(rows.reshape(len(rows), -1, width), 1)


def needed(x: np.ndarray, y: np.ndarray, threshold: int) -> np.ndarray:
    """Smallest intersection of sets of sizes ``x`` and ``y`` whose similarity reaches ``threshold`` per cent."""
    return -(-threshold * (x + y) // (100 + threshold))


class Vectors:
    """The parity vectors of a block of sets."""

    def __init__(self, raw: list[bytes]):
        self.width = np.array([len(r) // 8 for r in raw], np.int64)
        # vectors of one length lie together; ``row``: where a set's vector is among them
        self.row = np.zeros(len(raw), np.int64)
        self.held: dict[tuple[int, int], np.ndarray] = {}
        for width in set(self.width.tolist()):
            own = np.flatnonzero(self.width == width)
            self.row[own] = np.arange(len(own))
            self.held[width, width] = np.frombuffer(b"".join(raw[i] for i in own), "<u8").reshape(len(own), width)

    def _of(self, which: np.ndarray, width: int, to: int) -> np.ndarray:
        if (width, to) not in self.held:
            self.held[width, to] = folded(self.held[width, width], to)
        return self.held[width, to][self.row[which]]

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Elements, at least, that are in one set of each pair and not in the other."""
        out = np.zeros(len(i), np.int64)
        widths = self.width[i] << 32 | self.width[j]
        for both in set(widths.tolist()):
            mine, yours = both >> 32, both & 0xFFFFFFFF
            to = min(mine, yours)
            same = np.flatnonzero(widths == both)
            step = max(1, (1 << 20) // to)
            for lo in range(0, len(same), step):
                own = same[lo : lo + step]
                differ = self._of(i[own], mine, to) ^ self._of(j[own], yours, to)
                out[own] = np.bitwise_count(differ).sum(1, dtype=np.int64)
        return out
