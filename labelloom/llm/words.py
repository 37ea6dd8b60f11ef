"""Words of many texts at once: positions and 64-bit hashes by numpy, without a Python loop over words."""
from __future__ import annotations

import numpy as np

from labelloom.llm.common import CHUNK

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_BINV = np.uint64(pow(int(_B), -1, 1 << 64))
_SHIFT = [np.uint64(x) for x in (29, 32)]
_MIX = np.uint64(0xD6E8FEB86659FD93)

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, CHUNK + 1), base, np.uint64)
        known[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(known, out=known)
        _powers[int(base)] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value."""
    h = h ^ (h >> _SHIFT[1])
    h = h * _MIX
    h ^= h >> _SHIFT[0]
    h = h * _MIX
    return h ^ (h >> _SHIFT[1])


class Words:
    """Words of the texts in a byte run: ``start``/``end`` byte positions, ``doc`` index, ``h`` hash of the folded bytes.

    ``is_word`` and ``fold`` are tables of 256: which bytes belong to words, and what they are folded to.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray):
        self.n_docs = len(offsets) - 1
        self.data = fold[data]
        inside = is_word[data]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        before[edges] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[edges[edges > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        #: the words of text d are first[d] .. first[d + 1] - 1
        self.first = np.searchsorted(self.doc, np.arange(self.n_docs + 1))
        self.h = self._hashes()

    def __len__(self) -> int:
        return len(self.start)

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(out):  # runs of words of about CHUNK bytes
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + CHUNK, "right")))
            a, b = int(self.start[i]), int(self.end[j - 1])
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum((self.data[a:b].astype(np.uint64) + np.uint64(1)) * powers(_B, b - a), out=sums[1:])
            s, e = self.start[i:j] - a, self.end[i:j] - a
            out[i:j] = (sums[e] - sums[s]) * powers(_BINV, b - a)[s]
            i = j
        return mix(out)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words that begin at each word, and whether they all stand in one text."""
        n = len(self.h) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = np.zeros(n, np.uint64)
        for i in range(k):
            out += self.h[i:i + n] * powers(_B, k + 1)[i + 1]
        return mix(out), self.doc[:n] == self.doc[k - 1:k - 1 + n]

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()
