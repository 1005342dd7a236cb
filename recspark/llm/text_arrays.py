"""Words, lines and shingles of many texts at once, as numpy arrays.

The UTF-8 bytes of an Arrow column are read in place.  A span's hash is a
difference of prefix sums of ``T[byte] * P**i`` (mod 2**64) brought back to
position 0, so equal byte strings have equal hashes wherever they stand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_P_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _P)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i for i below n; kept, and grown by doubling."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_P, _P_INV)):
            t = np.full(size, base, _U)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers[0], _powers[1]


class Texts:
    """The texts of a column: bytes, offsets and words; a null text is empty."""

    def __init__(self, column: pa.Array, lower: bool = False):
        arr = column.cast(pa.large_string())
        n = len(arr)
        _, offsets, data = arr.buffers()
        off = (np.frombuffer(offsets, np.int64, n + 1, arr.offset * 8) if offsets is not None and n
               else np.zeros(n + 1, np.int64))
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.n = n
        self.bytes = raw[off[0]:off[-1]]
        self.off = off - off[0]
        if arr.null_count:  # a null's bytes, if any, count for nothing
            valid = np.array(arr.is_valid())
            if (np.diff(self.off)[~valid] > 0).any():
                filled = arr.fill_null("")
                self.__init__(pa.concat_arrays([filled]), lower)
                return
        size = len(self.bytes)
        self._inv = _power_tables(size + 1)
        value = (_BYTE_LOWER if lower else _BYTE)[self.bytes]
        value *= self._inv[0][:size]
        self._prefix = np.zeros(size + 1, _U)
        np.cumsum(value, out=self._prefix[1:])
        space = _SPACE[self.bytes]
        edge = np.zeros(size + 1, bool)
        edge[self.off] = True
        before = np.ones(size, bool)
        before[1:] = space[:-1]
        before |= edge[:-1]
        after = np.ones(size, bool)
        after[:-1] = space[1:]
        after |= edge[1:]
        word = ~space
        self.starts = np.flatnonzero(word & before)
        self.ends = np.flatnonzero(word & after) + 1
        self.doc = self.doc_of(self.starts)
        self.n_words = np.bincount(self.doc, minlength=n).astype(np.int64)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, side="right") - 1

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self._prefix[ends] - self._prefix[starts]) * self._inv[1][starts]
        return mix(h + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))

    def word_hashes(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        c = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=c[1:])
        return c[self.off[1:]] - c[self.off[:-1]]

    def windows(self, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the first word) of the runs of k words of a text."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        h = np.zeros(len(at), _U)
        for j in range(k):
            h = h * _P + words[at + j]
        return mix(h), at

    def shingle_sets(self, k: int) -> list[np.ndarray]:
        """Each text's sorted distinct k-word shingles; fewer words are one
        shingle, no word is none."""
        words = self.word_hashes()
        hashes, at = self.windows(words, k)
        bounds = np.searchsorted(self.doc[at], np.arange(self.n + 1))
        firsts = np.searchsorted(self.doc, np.arange(self.n + 1))
        out = []
        for i in range(self.n):
            n = self.n_words[i]
            if n >= k:
                out.append(np.unique(hashes[bounds[i]:bounds[i + 1]]))
            elif n:
                h = _U(n)
                with np.errstate(over="ignore"):
                    for w in words[firsts[i]:firsts[i + 1]]:
                        h = h * _P + w
                out.append(mix(np.array([h], _U) ^ _U(0xA5A5A5A5A5A5A5A5)))
            else:
                out.append(np.zeros(0, _U))
        return out
