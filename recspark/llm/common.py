"""Helpers shared by the operators: shared scratch tables and byte chunks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: White space that separates words, as a regular-expression class body.
SPACE_CLASS = "\\x20\\x09-\\x0D"
#: The same characters, as a string.
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Text bytes worked on at once inside a task (a longer text goes alone).
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``.  Where that is unset, a
    session on one machine (``local[...]``) uses a local folder, any other
    session raises: executors would write to their own disks.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"/tmp/recspark-shared-{sc.applicationId}"
    return root.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    The plan behind the result is then one scan, whose files outlive any
    executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/recspark-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_chunks(batch: pa.RecordBatch, column: str = "text",
                chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``chunk_bytes`` of text each."""
    texts = batch.column(column)
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        held += n or 0
        if held >= chunk_bytes:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


#: Bytes up to which a block's columns keep Arrow's 32-bit offsets.
SMALL_BLOCK = 1 << 30


def one_batch(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """All rows of ``parts`` as one batch, however many bytes they have: beyond
    SMALL_BLOCK texts and binaries get 64-bit offsets, as Arrow would otherwise
    cut the rows into several batches."""
    table = pa.Table.from_batches(parts)
    if table.nbytes > SMALL_BLOCK:
        wide = {pa.binary(): pa.large_binary(), pa.string(): pa.large_string()}
        table = table.cast(pa.schema([f.with_type(wide.get(f.type, f.type))
                                      for f in table.schema]))
    batches = table.combine_chunks().to_batches()
    if len(batches) != 1:
        raise ValueError(f"{table.num_rows} rows make {len(batches)} batches")
    return batches[0]


def sorted_blocks(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...],
                  step: int = 2048) -> Iterator[pa.RecordBatch]:
    """The blocks of rows with equal ``keys`` of batches sorted by them; null
    is no key.  Only the block at hand is held."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            cols = [part.column(k).to_numpy(zero_copy_only=False) for k in keys]
            new = np.zeros(part.num_rows, bool)
            first = tuple(c[0] for c in cols)
            new[0] = last is not None and first != last
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            start = 0
            for stop in np.flatnonzero(new).tolist():
                if stop > start:
                    rest.append(part.slice(start, stop - start))
                yield one_batch(rest)
                rest, start = [], stop
            rest.append(part.slice(start))
            last = tuple(c[-1] for c in cols)
    if rest:
        yield one_batch(rest)
