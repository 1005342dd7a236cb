"""The best k columns of each row of a large product, tile by tile.

A block of many thousand rows meets another one in tiles of bounded size; each row keeps
its k best so far, and from then on only entries that can still be among them are looked
at.  So blocks can be large, which keeps the copies of rows and the candidates of a
shuffle few, and a task holds two blocks of vectors, one tile and k entries a row.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE_ROWS = 1024
TILE_COLS = 2048
#: Numbers that the vectors of a block hold, at most (64 MB), and its rows.
BLOCK_NUMBERS = 8 << 20
BLOCK_ROWS = 1 << 17
#: Rounding of a score is far below this.
EPS = 1e-12


def block_rows_of(length: int) -> int:
    """Rows of a block of vectors of a length."""
    return max(TILE_ROWS, min(BLOCK_ROWS, BLOCK_NUMBERS // max(1, length)))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of numbers of one length -> (rows, length); null numbers are NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.empty((0, 0))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != lengths[0]).any():
        raise ValueError("vectors of different lengths")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(n, -1)


class Best:
    """The best ``k`` (a number, or one for each row) entries of rows, ties by the
    smaller id; with ``ties`` all entries as good as the k-th stay."""

    def __init__(self, rows: int, k, ties: bool = False, limit: int = 1 << 18):
        self.k = np.broadcast_to(np.asarray(k, np.int64), (rows,))
        self.most = int(self.k.max(initial=1))
        self.ties = ties
        self.limit = max(limit, 2 * int(self.k.sum()))
        self.least = np.full(rows, -np.inf)       # the k-th best score of a full row
        self._none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        self.held, self.n = [], 0

    def add(self, rows: np.ndarray, others: np.ndarray, scores: np.ndarray) -> None:
        if len(rows):
            self.held.append((rows, others, scores))
            self.n += len(rows)
        if self.n > self.limit:
            self.cut()
            self.limit = max(self.limit, 2 * self.n)

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, other, score) of what is left, by row and falling score."""
        row, other, score = (np.concatenate(c) for c in zip(self._none, *self.held))
        order = np.lexsort((other, -score, row))
        row, other, score = row[order], other[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last = place == self.k[row] - 1
        self.least[row[last]] = score[last]
        keep = place < self.k[row]
        if self.ties:
            keep |= score >= self.least[row]
        self.held = [(row[keep], other[keep], score[keep])]
        self.n = int(keep.sum())
        return self.held[0]


def hits(s: np.ndarray, bound: np.ndarray, most: int, slack) -> tuple[np.ndarray, np.ndarray]:
    """Places in a tile that reach their row's bound; where these are many, only those
    that reach the row's ``most``-th best less ``slack`` (a number, or one a row)."""
    slack = np.broadcast_to(np.asarray(slack, s.dtype), (len(s),))
    some = np.flatnonzero(~(s.max(axis=1, initial=-np.inf) < bound))    # NaN passes here
    if 2 * len(some) < len(s):                  # later tiles have hits for few rows
        i, j = _hits(s[some], bound[some], most, slack[some])
        return some[i], j
    return _hits(s, bound, most, slack)


def _hits(s: np.ndarray, bound: np.ndarray, most: int, slack: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    mask = s >= bound[:, None]
    if s.shape[1] > most and np.count_nonzero(mask) > 4 * most * len(s):
        kth = np.partition(s, s.shape[1] - most, axis=1)[:, s.shape[1] - most]
        mask &= s >= (kth - slack)[:, None]
    return np.nonzero(mask)


#: Rows and columns of a tile of single numbers, which a core's cache holds.
SINGLE_ROWS = 512
SINGLE_COLS = 1024


def single_slack(length: int) -> float:
    """What a product of vectors in single precision may be off, as a share of the norms."""
    return (length + 4) * 2.0 ** -23


def below(x: np.ndarray) -> np.ndarray:
    """Single numbers that are no larger."""
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(np.float32), np.float32(-np.inf))
