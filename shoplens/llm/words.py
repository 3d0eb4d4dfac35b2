"""Vectorised words and word hashes over the UTF-8 bytes of an Arrow column.

Two word classes are used: runs of anything but ASCII white space
(``[^\\x20\\x09-\\x0D]+``) and runs of letters, digits and non-ASCII characters
(``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z).  Both are
unions of ASCII bytes and all bytes of multi-byte characters, so working on
bytes gives the words that working on characters gives.

A word's hash has 64 bits and is equal on every machine and in every run: the
word's bytes are taken eight at a time and chained through a bijection that is
not linear, beginning with the word's length; words over ``LONG`` bytes take a
cryptographic digest instead.  Different words share a hash with probability
2**-64, whatever pattern their letters follow.
"""

from __future__ import annotations

import hashlib

import numpy as np

_BYTES = np.arange(256)
NON_SPACE = ~np.isin(_BYTES, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_rng = np.random.Generator(np.random.PCG64(20240607))
STEP = [np.uint64(int(x) | 1) for x in _rng.integers(1, 1 << 63, 8, dtype=np.uint64)]
#: Words of more bytes are hashed one by one.
LONG = 128
_LENGTH_SEED = np.uint64(0x9E3779B97F4A7C15)
#: Keeps the first n bytes of a block of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (public-domain finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes ``data[start:end]`` of each run."""
    lengths = ends - starts
    out = mix((lengths.astype(np.uint64) + np.uint64(1)) * _LENGTH_SEED)
    short = lengths <= LONG
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    # the eight bytes from each place on, as one number
    blocks = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    left, done = np.flatnonzero(short & (lengths > 0)), 0
    while len(left):
        kept = _FIRST[np.minimum(lengths[left] - done, 8)]
        out[left] = mix(out[left] ^ (blocks[starts[left] + done] & kept))
        done += 8
        left = left[lengths[left] > done]
    for i in np.flatnonzero(~short):
        digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest()
        out[i] ^= np.uint64(int.from_bytes(digest, "little"))
    return out


class Words:
    """Words of a slice of documents.

    ``starts``/``ends`` are byte positions, ``ptr[d]:ptr[d + 1]`` are the words
    of document ``d``.  A document without text has none.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray, word_class: np.ndarray, lower: bool):
        self.offsets = offsets
        self.data = LOWER[data] if lower else data
        inside = word_class[self.data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.ptr = np.searchsorted(self.starts, offsets)

        self._hashes: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def only(self, which: np.ndarray) -> Words:
        """Some of the words, without their documents."""
        out = Words.__new__(Words)
        out.data, out.starts, out.ends = self.data, self.starts[which], self.ends[which]
        out.ptr, out._hashes = np.array([0, len(which)]), self.hashes()[which]
        return out

    def docs(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        if self._hashes is None:
            self._hashes = hash_runs(self.data, self.starts, self.ends)
        return self._hashes

    def prefix_hashes(self, length: int) -> np.ndarray:
        """Hash of the first ``length`` bytes of each word (all of a shorter word)."""
        return hash_runs(self.data, self.starts, np.minimum(self.ends, self.starts + length))


def windows(hashes: np.ndarray, ptr: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words and their pointer per document.

    A document with fewer words, but at least one, has none here.
    """
    counts = np.diff(ptr)
    n = np.maximum(counts - size + 1, 0)
    out_ptr = np.concatenate(([0], np.cumsum(n)))
    # position of each window's first word
    first = np.arange(out_ptr[-1]) + np.repeat(ptr[:-1] - out_ptr[:-1], n)
    out = np.zeros(len(first), np.uint64)
    for k in range(size):
        out += hashes[first + k] * STEP[k]
    return mix(out), out_ptr
