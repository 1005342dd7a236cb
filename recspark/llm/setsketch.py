"""Near-duplicate documents by SetSketch registers.

A document's set holds its distinct word shingles as 64-bit hashes.  Every
element walks the registers in an order of its own with ascending,
exponentially spaced values (the order statistics of ``REGISTERS`` exponential
numbers of rate ``RATE``); a register keeps the smallest value it is offered,
truncated to ``floor(1 - log_B(x))`` in 0 .. Q + 1.  An element stops once its
next value cannot lower any register, so a large set costs a few steps an
element.  Registers of two sketches merge by their maximum.

For a base this close to 1 two registers are equal about as often as the
Jaccard similarity says, so bands of register values are the keys of the
candidate search.  Pairs of a band are screened by the joint maximum-likelihood
estimate of the similarity from both sketches and both exact set sizes, then
confirmed on the full sets.

Copies and groups.  Equal sets are one class, found by a 128-bit digest.  Only
classes that share a band with another one go on.  In each band one class, the
center, is paired with those of other components: a number of pairs linear in
the band.  After the first round (the smallest class is the center) come
``ROUNDS`` more with centers drawn by hash, in bands that still hold several
components.  What is left, pairs across components of a band, is compared inside
tasks in blocks of ``BLOCK`` rows a side: a first pass screens by the sketches
and keeps the rows that have a candidate, a second one takes their full sets,
compares, and returns links.  A pair that shares several bands counts in the
first.  So a group of thousands of copies never becomes all its pairs, and no
link between two components of a band is left out.

Defined results: documents without a word (null, empty) have an empty set, link
with nothing and are their own component; a row without an id links with
nothing, has a null component and is kept; rows that repeat an id and its text
are one document, a further text of the same id is a document of its own with
its own links; a component is named by its smallest id and keeps the rows with
that id, so ids that several texts share can name several components; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import materialize, sorted_blocks, text_chunks
from recspark.llm.components import connected_components
from recspark.llm.text_arrays import Texts, mix

SHINGLE = 5
THRESHOLD_PERCENT = 75

REGISTERS = 256
BASE = 1.001
RATE = 20.0
Q = 65534
#: Registers in a band: 51 bands find a pair at 0.75 with probability 1 - 1e-6.
ROWS = 5
#: A pair is verified unless its estimate is lower than the threshold by 4.5
#: standard errors of 256 registers; a pair at the threshold is lost by that
#: with probability 3e-6.
MARGIN = 4.5 * (0.75 * 0.25 / REGISTERS) ** 0.5
#: Rounds with centers drawn by hash, after the round with the smallest class.
ROUNDS = 1
#: The estimate a pair must reach to be verified.
LEAST = THRESHOLD_PERCENT / 100 - MARGIN
#: Rows of a side of a block of pairs, and bytes of their sets, about.
BLOCK = 512
BLOCK_BYTES = 128 << 20

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def sketch_sets(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (len(sets) x REGISTERS, uint16) of sets of 64-bit hashes."""
    n = len(sets)
    least = np.full(n * REGISTERS, np.inf)
    sizes = np.array([len(s) for s in sets], np.int64)
    h = np.concatenate([np.zeros(0, _U), *sets])
    doc = np.repeat(np.arange(n), sizes)
    walk = mix(h ^ _U(0x5851F42D4C957F2D))
    reg = (walk & _U(REGISTERS - 1)).astype(np.int64)
    stride = ((walk >> _U(32)) & _U(REGISTERS - 1) | _U(1)).astype(np.int64)
    seed = mix(h + _STEP)
    x = np.zeros(len(h))
    for j in range(REGISTERS):
        if not len(doc):
            break
        u = ((mix(seed + _U((j + 1) * int(_STEP) % 2 ** 64)) >> _U(11)).astype(np.float64) + 0.5
             ) * 2.0 ** -53
        x = x - np.log(u) / (RATE * (REGISTERS - j))
        np.minimum.at(least, doc * REGISTERS + reg, x)
        # An element goes on while its next value may be below some register.
        live = x < least.reshape(n, REGISTERS).max(axis=1)[doc]
        doc, seed, x, stride = doc[live], seed[live], x[live], stride[live]
        reg = (reg[live] + stride) & (REGISTERS - 1)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(k, 0, Q + 1).astype(np.uint16).reshape(n, REGISTERS)


#: The registers in the order in which bands take them.  An element walks the
#: registers in equal steps; neighbours in this order are no neighbours of a walk.
_BANDED = np.random.default_rng(256).permutation(REGISTERS)


def merge_sketches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band and sketch (len x REGISTERS // rows)."""
    bands = REGISTERS // rows
    r = registers[:, _BANDED[:bands * rows]].astype(_U).reshape(len(registers), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=_U) * _STEP, r.shape[:2]).copy()
    for j in range(rows):
        key = mix(key * _STEP + r[:, :, j])
    return key.view(np.int64)


def _chances(j, n_a: np.ndarray, n_b: np.ndarray):
    """Of a register: the chances that a's is larger, that b's is larger, and
    their derivatives by j."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    f = (BASE - 1) / BASE
    x, y = np.clip(u - v * j, 1e-12, 1), np.clip(v - u * j, 1e-12, 1)
    log_b = np.log(BASE)
    return (-np.log1p(-x * f) / log_b, -np.log1p(-y * f) / log_b,
            -v * f / (1 - x * f) / log_b, -u * f / (1 - y * f) / log_b)


def _counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    return larger, smaller, a.shape[1] - larger - smaller


def estimate_jaccard(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray
                     ) -> np.ndarray:
    """Joint maximum-likelihood estimate for rows of registers and set sizes.

    With u = n_a / (n_a + n_b), v = 1 - u and p(x) = -log_B(1 - x (B-1) / B), a
    register of a is the larger with probability p(u - v J), of b with
    p(v - u J).  The log-likelihood is concave in J; the sign of its slope
    brackets the maximum on [0, min(n_a / n_b, n_b / n_a)].
    """
    larger, smaller, equal = _counts(a, b)
    lo, hi = np.zeros(len(n_a)), np.minimum(n_a / n_b, n_b / n_a)
    for _ in range(30):
        mid = (lo + hi) / 2
        up = _slope(larger, smaller, equal, n_a, n_b, mid) >= 0
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
    return (lo + hi) / 2


def _slope(larger, smaller, equal, n_a, n_b, j) -> np.ndarray:
    """Slope of the log-likelihood at j."""
    p, q, dp, dq = _chances(j, n_a, n_b)
    return larger * dp / p + smaller * dq / q - equal * (dp + dq) / np.clip(1 - p - q, 1e-12, 1)


def estimate_reaches(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
                     least: float) -> np.ndarray:
    """Whether the estimate is ``least`` or more: the slope there isn't negative."""
    return ((np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b))
            & (_slope(*_counts(a, b), n_a, n_b, least) >= 0))


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch):
            sets = Texts(part.column("text"), lower=True).shingle_sets(SHINGLE)
            reg = sketch_sets(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row_id"),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(map(_digest, sets), pa.binary()),
                 pa.array([r.tobytes() for r in reg], pa.binary())],
                ["doc_id", "row_id", "n_shingles", "digest", "registers"])


def _row_id() -> Column:
    """Tells apart rows with the same document id."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def sketch_documents(docs: DataFrame) -> DataFrame:
    """doc_id, row_id, n_shingles, digest (null: empty set) and registers of
    each row."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text"), _row_id().alias("row_id")) \
        .mapInArrow(_sketch_batches, "doc_id long, row_id long, n_shingles long, digest binary, "
                    "registers binary")


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            reg = _registers(part.column("registers"))
            keys = band_keys(reg)
            rep = np.repeat(part.column("rep").to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(rep)],
                                             ["key", "rep"])


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _estimate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            n_a, n_b = (part.column(c).to_numpy(zero_copy_only=False).astype(float)
                        for c in ("n_a", "n_b"))
            ok = estimate_reaches(_registers(part.column("r_a")), _registers(part.column("r_b")),
                                  n_a, n_b, LEAST)
            yield part.select(["a", "b"]).filter(pa.array(ok))


def _digest(s: np.ndarray) -> bytes | None:
    """128 bits that stand for a set; none for the empty one."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch):
            sets = Texts(part.column("text"), lower=True).shingle_sets(SHINGLE)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(map(_digest, sets), pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([r.tobytes() for r in sketch_sets(sets)], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                ["doc_id", "digest", "n", "registers", "shingles"])


def _block_pairs(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of a block whose estimate passes: of different components,
    meeting in this band first."""
    comp, n, own, key = (b.column(c).to_numpy(zero_copy_only=False)
                         for c in ("component", "n", "own", "key"))
    reg = _registers(b.column("registers"))
    bands = band_keys(reg)
    p, q = b.column("p")[0].as_py(), b.column("q")[0].as_py()
    left = np.flatnonzero(own == p)
    right = left if p == q else np.flatnonzero(own == q)
    small, large = (f(n[left][:, None], n[right]) for f in (np.minimum, np.maximum))
    ok = (comp[left][:, None] != comp[right]) & (100 * small >= THRESHOLD_PERCENT * large)
    i, j = np.nonzero(np.triu(ok, 1) if p == q else ok)
    i, j = left[i], right[j]
    kept = [np.zeros((2, 0), np.int64)]
    for at in range(0, len(i), 8192):
        x, y = i[at:at + 8192], j[at:at + 8192]
        first = (bands[x] == bands[y]).argmax(axis=1)
        here = bands[x, first] == key[0]
        x, y = x[here], y[here]
        good = estimate_reaches(reg[x], reg[y], n[x].astype(float), n[y].astype(float), LEAST)
        kept.append(np.array([x[good], y[good]]))
    return tuple(np.concatenate(kept, axis=1))


def _open_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a block that have a candidate in it."""
    for block in sorted_blocks(batches, ("key", "p", "q")):
        i, j = _block_pairs(block)
        if len(i):
            rows = np.unique(np.concatenate([i, j]))
            yield block.take(pa.array(rows)).select(["rep", "key", "component", "own", "p", "q"])


def _across_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The linked pairs (a, b) across components of a block."""
    for block in sorted_blocks(batches, ("key", "p", "q")):
        i, j = _block_pairs(block)
        rep = block.column("rep").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x, _U) for x in block.column("shingles").to_pylist()]
        good = np.array([linked(sets[x], sets[y]) for x, y in zip(i, j)], bool)
        if good.any():
            a, b = rep[i[good]], rep[j[good]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def linked(a: np.ndarray, b: np.ndarray, percent: int = THRESHOLD_PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct sets."""
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s_a, s_b = batch.column("s_a"), batch.column("s_b")
        held: tuple[object, np.ndarray] = (None, np.zeros(0, _U))
        keep = []
        for i, rep in enumerate(batch.column("a").to_pylist()):
            if rep != held[0]:
                held = (rep, np.frombuffer(s_a[i].as_buffer(), _U))
            keep.append(linked(held[1], np.frombuffer(s_b[i].as_buffer(), _U)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _size_ok(n_a: str, n_b: str) -> Column:
    """Sets whose sizes allow the threshold."""
    return 100 * F.least(n_a, n_b) >= THRESHOLD_PERCENT * F.greatest(n_a, n_b)


def _confirm(pairs: DataFrame, members: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) of classes that are linked: screened by their sketches,
    then compared on full sets."""
    a, b = (members.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"),
                           F.col("registers").alias(f"r_{x}")) for x in "ab")
    screened = materialize(
        pairs.join(a, "a").join(b, "b").where(_size_ok("n_a", "n_b"))
        .select("a", "b", "n_a", "n_b", "r_a", "r_b")
        .mapInArrow(_estimate_batches, "a long, b long"), f"{name}-screened")
    s_a, s_b = (members.select(F.col("rep").alias(x), F.col("shingles").alias(f"s_{x}"))
                for x in "ab")
    return materialize(screened.join(s_b, "b").join(s_a, "a").select("a", "b", "s_a", "s_b")
                       .mapInArrow(_verify_batches, "a long, b long"), f"{name}-links")


def _across(labelled: DataFrame, members: DataFrame) -> DataFrame:
    """The linked pairs across components of a band, compared in blocks."""
    several = (labelled.groupBy("key").agg(F.min("component").alias("x"),
                                           F.max("component").alias("y"))
               .where("x <> y").select("key"))
    open_rows = materialize(labelled.join(several, "key").join(members.select("rep", "n"), "rep"),
                            "open")
    keys = open_rows.groupBy("key").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES))
        .cast("int").alias("parts"))
    dealt = (open_rows.join(keys, "key")
             .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("rep", "key", "component", "own", F.least("own", "other").alias("p"),
                     F.greatest("own", "other").alias("q")))

    def in_blocks(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "rep")

    sketch = members.select("rep", "n", "registers")
    row = "rep long, key long, component long, own int, p int, q int"
    near = materialize(in_blocks(dealt.join(sketch, "rep")).mapInArrow(_open_batches, row), "near")
    return materialize(in_blocks(near.join(members, "rep"))
                       .mapInArrow(_across_batches, "a long, b long"), "across-links")


def _with_components(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return rows.withColumn("component", F.col("rep"))
    parts = connected_components(links).withColumnRenamed("id", "rep")
    return materialize(rows.join(parts, "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")), "labelled")


def _open_centers(labelled: DataFrame, order: Column) -> DataFrame:
    """The center of each band that holds several components."""
    one = F.struct(order.alias("o"), F.col("rep").alias("center"),
                   F.col("component").alias("c_center"))
    return (labelled.groupBy("key").agg(F.min(one).alias("m"), F.min("component").alias("x"),
                                        F.max("component").alias("y"))
            .where("x <> y").select("key", "m.center", "m.c_center"))


def _label_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row_id, n_shingles, component_id and kept of every row."""
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    sketches = materialize(sketch_documents(texts), "sketches")
    # One row per set; rep is a key of its own, as several sets may have the
    # same smallest id.
    classes = materialize(
        sketches.where("digest is not null and doc_id is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"))
        .select("digest", "doc_id", F.monotonically_increasing_id().alias("rep")), "classes")
    reps = (sketches.select("doc_id", "digest", "registers").join(classes, ["doc_id", "digest"])
            .select("rep", "registers").dropDuplicates(["rep"]))
    bands = materialize(reps.mapInArrow(_band_batches, "key long, rep long"), "bands")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    crowded = materialize(bands.join(shared, "key"), "crowded")
    # Full sets of the classes that share a band, made again from their texts;
    # the join is the same at every size.
    met = classes.join(crowded.select("rep").distinct(), "rep", "left_semi")
    wanted = met.select("doc_id").distinct()
    members = materialize(
        texts.join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(
            _set_batches, "doc_id long, digest binary, n long, registers binary, shingles binary")
        .join(met, ["doc_id", "digest"]).select("rep", "n", "registers", "shingles")
        .dropDuplicates(["rep"]), "members")
    links = None
    for i in range(ROUNDS + 1):
        labelled = _with_components(crowded, links)
        order = F.xxhash64(F.lit(i), "key", "rep") if i else F.col("rep")
        pairs = (labelled.join(_open_centers(labelled, order), "key")
                 .where("component <> c_center")
                 .select(F.least("rep", "center").alias("a"), F.greatest("rep", "center").alias("b"))
                 .distinct())
        found = _confirm(pairs, members, f"round{i}")
        links = found if links is None else links.union(found)
    links = links.union(_across(_with_components(crowded, links), members))
    final = connected_components(links).withColumnRenamed("id", "rep")
    # Only here a component takes the smallest id of its documents as its name.
    grouped = materialize(classes.join(final, "rep"), "grouped")
    names = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(names, "component").select("rep", "component_id")
    labels = classes.join(named, "rep", "left").select(
        "digest", F.coalesce("component_id", "doc_id").alias("component"))
    return (sketches.select("doc_id", "row_id", "n_shingles", "digest")
            .join(labels, "digest", "left")
            .select("doc_id", "row_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    return _label_rows(docs).drop("row_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one
    with the smallest id.  A row goes by its id and its text."""
    gone = (_label_rows(docs).where(~F.col("kept"))
            .select(F.col("doc_id").alias("_gone"), F.col("row_id").alias("_gone_row")).distinct())
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["_gone"])
                     & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_gone_row"]),
                     "left_anti")
