"""Vectors in flat files of the shared folder, which workers map.

Where every row of a table may have to meet every other, copies of rows for each pair of
blocks fill the disk: their number grows with the square of the rows.  Here the rows lie
in files once, and a task holds some rows of the other side, one tile of the file and the
best so far.
"""

from __future__ import annotations

import os
import shutil
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.session import scratch_path, shared_folder, write_tidied

_cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of copies from which on vectors lie in files.
MOST_COPIES = 1 << 30
#: Bits of a row's place in its partition, in Spark's increasing ids.
PLACE_BITS = 33


@dataclass
class Flat:
    """``n`` rows: ids, norms and vectors of one length, each in a file of ``folder``."""

    folder: str
    n: int
    length: int
    kind: str

    def make(self, name: str, size: int) -> None:
        """A file of ``size`` bytes a row."""
        with open(f"{self.folder}/{name}", "wb") as f:
            f.truncate(self.n * size)

    def write(self, name: str, start: int, values: np.ndarray) -> None:
        """Rows from ``start`` on; a task that is run again writes the same ones."""
        _write(f"{self.folder}/{name}", start * values[:1].nbytes, values)

    def file(self, name: str, kind, shape: tuple) -> np.ndarray:
        if not self.n or not self.length:
            return np.empty(shape, kind)
        return np.asarray(np.memmap(f"{self.folder}/{name}", kind, "r", shape=shape))

    def ids(self) -> np.ndarray:
        return self.file("ids", np.int64, (self.n,))

    def norms(self) -> np.ndarray:
        return self.file("norms", np.float64, (self.n,))

    def vectors(self) -> np.ndarray:
        return self.file("vectors", np.dtype(self.kind), (self.n, self.length))


def _write(path: str, at: int, values: np.ndarray) -> None:
    left = memoryview(np.ascontiguousarray(values)).cast("B")
    fd = os.open(path, os.O_WRONLY)
    try:
        while len(left):
            n = os.pwrite(fd, left, at)
            at, left = at + n, left[n:]
    finally:
        os.close(fd)


def _write_batches(flat: Flat, shifts: dict[int, int]):
    """Rows to their places, which are the same when a task is run again."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            at = b.column("_at").to_numpy()
            part = at >> PLACE_BITS
            shift = np.array([shifts[p] for p in part.tolist()], np.int64)
            place = at + shift
            v = b.column("vector").flatten().to_numpy(zero_copy_only=False).astype(flat.kind)
            columns = (("ids", b.column("id").to_numpy()), ("norms", b.column("norm").to_numpy()),
                       ("vectors", v.reshape(len(at), flat.length)))
            cuts = [0, *(np.flatnonzero(np.diff(place) != 1) + 1).tolist(), len(at)]
            for s, e in zip(cuts[:-1], cuts[1:]):
                for name, values in columns:
                    flat.write(name, int(place[s]), values[s:e])
            yield pa.RecordBatch.from_arrays([pa.array([len(at)], pa.int64())], ["n"])
    return write


def written(rows: DataFrame, name: str) -> Flat | None:
    """(id, vector, norm) in files; None where workers cannot open the shared folder."""
    folder = scratch_path(rows.sparkSession, name)
    local = shared_folder(rows.sparkSession, folder)
    if local is None:
        return None
    os.makedirs(local)
    numbered = rows.select("id", "vector", F.col("norm").cast("double").alias("norm"),
                           F.monotonically_increasing_id().alias("_at"))
    table = write_tidied(numbered, f"{folder}/rows")
    parts = table.groupBy(F.shiftright("_at", PLACE_BITS).alias("part")).agg(
        F.min("_at").alias("first"), F.count(F.lit(1)).alias("n"),
        F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")
    ).orderBy("part").collect()
    if len({x for r in parts for x in (r["least"], r["most"])}) > 1:
        raise ValueError("vectors of different lengths")
    shifts, n = {}, 0
    for r in parts:
        shifts[r["part"]] = n - r["first"]
        n += r["n"]
    single = isinstance(rows.schema["vector"].dataType.elementType, T.FloatType)
    flat = Flat(local, n, parts[0]["least"] if parts else 0, "float32" if single else "float64")
    for part, size in (("ids", 8), ("norms", 8), ("vectors", flat.length * int(flat.kind[-2:]) // 8)):
        flat.make(part, size)
    if n and flat.length:
        table.mapInArrow(_write_batches(flat, shifts), "n long").agg(F.sum("n")).collect()
    shutil.rmtree(f"{local}/rows")
    return flat
