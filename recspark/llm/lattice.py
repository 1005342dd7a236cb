"""Near-duplicate vectors by E8 lattice hashing.

Unit vectors are projected to eight random directions per table, scaled by
1 / ``WIDTH``, and decoded to the nearest point of the E8 lattice.  A vector is
at home in that cell and is also sent as a visitor to the ``PROBES`` of the 240
neighbouring lattice points that lie nearest to it.  Two vectors meet in a
table if they share their home, or one visits the other's home.  At a cosine of
0.93 that has probability 0.71 a table, 0.9994 with six tables; closer pairs
meet almost surely.  Met pairs are verified by their cosine in double precision.

Groups.  Equal vectors are one row with a multiplicity.  A cell with more than
``BLOCK`` rows is dealt out by hash into parts, and each pair of parts is a task
of bounded size, so a cell is compared completely however many rows it has.  A
block never returns pairs: it returns per row how many vectors it links with,
and one edge to the smallest row of its component in the block.  A pair that
meets in several cells counts in the first (smallest table; shared home before
visits), which both rows know from the cells they carry.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component, and vectors with a null label, link with nothing and are
their own component; vectors of unequal length are not compared; a row without
an id links with nothing, has a null component and is kept; rows that repeat an
id and its vector count as many vectors, and an id with several vectors or
labels links with each of them; a component is named by its smallest id and
keeps the rows with that id; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import materialize, one_batch
from recspark.llm.components import connected_components
from recspark.llm.text_arrays import mix

MIN_COSINE = 0.93
TABLES = 6
PROBES = 4
WIDTH = 1.5
BLOCK = 512

_U = np.uint64


def decode_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points: whole or half-odd coordinates, even sum."""
    best, dist = None, None
    for shift in (0.0, 0.5):
        f = np.rint(x - shift)
        d = x - shift - f
        odd = np.flatnonzero(f.sum(axis=1).astype(np.int64) & 1)
        k = np.abs(d[odd]).argmax(axis=1)      # the coordinate that is nearest to its other side
        f[odd, k] += np.where(d[odd, k] >= 0, 1.0, -1.0)
        p = f + shift
        far = ((x - p) ** 2).sum(axis=1)
        if best is None:
            best, dist = p, far
        else:
            nearer = far < dist
            best[nearer] = p[nearer]
    return best


def minimal_vectors() -> np.ndarray:
    """The 240 shortest lattice vectors."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(out)


def projection(dim: int, table: int) -> np.ndarray:
    return np.random.default_rng([8, dim, table]).normal(size=(dim, 8)) / WIDTH


def _cell_key(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """64-bit keys of lattice points (..., 8) with a salt per row."""
    key = salt
    whole = np.rint(points * 2).astype(np.int64).view(_U)
    for j in range(8):
        key = mix(key * _U(0x9E3779B97F4A7C15) + whole[..., j])
    return key.view(np.int64)


def lattice_keys(unit: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home keys (rows, TABLES) and visited keys (rows, TABLES, PROBES)."""
    n, dim = unit.shape
    short = minimal_vectors()
    home, visit = np.empty((n, TABLES), np.int64), np.empty((n, TABLES, PROBES), np.int64)
    for t in range(TABLES):
        x = unit @ projection(dim, t)
        # Steps of their own: no sum of label, length and table equals another one.
        salt = mix(labels.astype(np.int64).view(_U))
        salt = mix(mix(salt + _U(dim)) + _U(t))
        h = decode_e8(x)
        # All neighbours are equally far from h: the nearest to x has the largest product.
        best = np.argsort(-((x - h) @ short.T), axis=1, kind="stable")[:, :PROBES]
        home[:, t] = _cell_key(h, salt)
        visit[:, t] = _cell_key(h[:, None] + short[best], np.repeat(salt[:, None], PROBES, 1))
    return home, visit


def _unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """Unit vectors (double) from vectors as bytes of float32 or float64."""
    kind = np.float32 if width == 4 else np.float64
    x = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)
    return unit_vectors(x.astype(np.float64))


def unit_vectors(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)   # squares stay finite
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))


def _by_length(column: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) for each vector length."""
    length = np.array([len(b) for b in column.to_pylist()])
    for size in np.unique(length):
        rows = np.flatnonzero(length == size)
        yield rows, _unit_rows(column.take(pa.array(rows)), width)


def digest_vectors(df: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, label, vector (bytes) and digest of each row (null: cannot link),
    and the bytes of a component."""
    kind = df.schema["embedding"].dataType.elementType.typeName()
    width = 4 if kind == "float" else 8
    e = F.col("embedding")
    fit = (e.isNotNull() & (F.size(e) > 0) & F.col("label").isNotNull()
           & F.col("vec_id").isNotNull()
           & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf"))))
           & F.exists(e, lambda x: x != 0))
    rows = df.select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                     F.when(fit, e if width == 4 else e.cast("array<double>")).alias("embedding"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec, dig = [], []
            for label, x in zip(b.column("label").to_pylist(), b.column("embedding")):
                v = None
                if x.is_valid:                 # +0.0 and -0.0 are one number
                    v = (x.values.to_numpy(zero_copy_only=False) + 0.0).tobytes()
                vec.append(v)
                dig.append(v and hashlib.blake2b(v, digest_size=16,
                                                 salt=label.to_bytes(8, "big", signed=True)
                                                 ).digest())
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(vec, pa.binary()),
                 pa.array(dig, pa.binary())], ["vec_id", "label", "vector", "digest"])

    return rows.mapInArrow(encode, "vec_id long, label long, vector binary, digest binary"), width


def _key_batches(width: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                labels = b.column("label").to_numpy(zero_copy_only=False)
                for rows, unit in _by_length(b.column("vector"), width):
                    home, visit = lattice_keys(unit, labels[rows])
                    part = b.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("rep"), part.column("n"), part.column("label"),
                         part.column("vector"), pa.array(list(home), pa.list_(pa.int64())),
                         pa.array(list(visit.reshape(len(rows), -1)), pa.list_(pa.int64()))],
                        ["rep", "n", "label", "vector", "home", "visit"])
    return keys


def _first_meeting(a: dict, b: dict, i: np.ndarray, j: np.ndarray, table: int, key: int
                   ) -> np.ndarray:
    """Whether this cell is the first where rows i of a and j of b meet."""
    ha, hb, va, vb = a["home"][i], b["home"][j], a["visit"][i], b["visit"][j]
    ok = np.ones(len(i), bool)
    for t in range(table):
        ok &= ha[:, t] != hb[:, t]
        ok &= ~(va[:, t] == hb[:, t, None]).any(axis=1)
        ok &= ~(vb[:, t] == ha[:, t, None]).any(axis=1)
    # In this table: one home for both, or the home of the smaller of two visited ones.
    at_a, at_b = ha[:, table] == key, hb[:, table] == key
    other = np.where(at_a, (va[:, table] == hb[:, table, None]).any(axis=1),
                     (vb[:, table] == ha[:, table, None]).any(axis=1))
    first = np.where(at_a, a["rep"][i] < b["rep"][j], b["rep"][j] < a["rep"][i])
    return ok & ((at_a & at_b) | ~other | first)


def _local_components(rep: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Each row's smallest rep by links (i, j)."""
    label = rep.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        if (new == label).all():
            return label
        label = new


def compare_block(rows: dict, part: np.ndarray, table: int, key: int, cosine: float):
    """Links of a cell's block: (rep, linked vectors, component) of its rows.

    ``part`` 0 and 1 mark two parts of a divided cell, whose rows are compared
    across; with one part its rows are compared among themselves.
    """
    left = np.flatnonzero(part == 0)
    right = np.flatnonzero(part == 1) if (part == 1).any() else left
    s = rows["unit"][left] @ rows["unit"][right].T
    i, j = np.nonzero(s >= cosine)
    i, j = left[i], right[j]
    if right is left:
        i, j = i[i < j], j[i < j]
    # Two visitors of a cell don't meet in it.
    met = (rows["home"][i, table] == key) | (rows["home"][j, table] == key)
    i, j = i[met], j[met]
    component = _local_components(rows["rep"], i, j)
    first = _first_meeting(rows, rows, i, j, table, key)
    n = np.zeros(len(rows["rep"]), np.int64)
    np.add.at(n, i[first], rows["n"][j[first]])
    np.add.at(n, j[first], rows["n"][i[first]])
    hit = np.flatnonzero((n > 0) | (component != rows["rep"]))
    return rows["rep"][hit], n[hit], component[hit]


def _block_batches(width: int, cosine: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []

        def blocks(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            b = one_batch(parts)
            key, p, q = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "p", "q"))
            cut = np.flatnonzero((key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1
            bounds = [0, *cut.tolist(), len(key)]
            col = {c: b.column(c).to_numpy(zero_copy_only=False)
                   for c in ("rep", "n", "t", "own", "label")}
            home = np.array(b.column("home").to_pylist(), np.int64).reshape(-1, TABLES)
            visit = np.array(b.column("visit").to_pylist(), np.int64).reshape(-1, TABLES, PROBES)
            vector = b.column("vector")
            size = pc.binary_length(vector).to_numpy(zero_copy_only=False)
            out = []
            for s, e in zip(bounds[:-1], bounds[1:]):
                # Rows with one key are of one table, label and length, unless their
                # keys collide: then those of each are compared among themselves.
                kind = np.stack([col["t"][s:e], col["label"][s:e], size[s:e]], 1)
                kinds = [kind[0]] if (kind == kind[0]).all() else np.unique(kind, axis=0)
                for k in kinds:
                    at = s + np.flatnonzero((kind == k).all(axis=1))
                    # Rows are in order of rep; one that has the key twice counts once.
                    at = at[np.append(True, col["rep"][at[1:]] != col["rep"][at[:-1]])]
                    if len(at) < 2:
                        continue
                    rows = {"rep": col["rep"][at], "n": col["n"][at], "home": home[at],
                            "visit": visit[at], "unit": _unit_rows(vector.take(pa.array(at)), width)}
                    part = (col["own"][at] != p[at]).astype(int)
                    out.append(compare_block(rows, part, int(k[0]), int(key[s]), cosine))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([o[k] for o in out])) for k in range(3)],
                    ["rep", "n", "c"])

        for b in batches:
            for at in range(0, b.num_rows, 4 * BLOCK):
                some = b.slice(at, 4 * BLOCK)
                last = [some.column(c)[some.num_rows - 1].as_py() for c in ("key", "p", "q")]
                same = np.ones(some.num_rows, bool)
                for c, v in zip(("key", "p", "q"), last):
                    same &= some.column(c).to_numpy(zero_copy_only=False) == v
                tail = int(some.num_rows - same.sum())
                if tail:                       # sorted: all before the last block is whole
                    yield from blocks([*rest, some.slice(0, tail)])
                    rest = []
                rest.append(some.slice(tail))
        if rest:
            yield from blocks(rest)
    return compare


def near_duplicate_vectors(df: DataFrame, cosine: float = MIN_COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``df``."""
    digested, width = digest_vectors(df)
    rows = materialize(digested, "vectors")
    # rep is a key of its own: several vectors may have the same smallest id.
    classes = (rows.where("digest is not null").groupBy("digest")
               .agg(F.min("vec_id").alias("vec_id"), F.first("label").alias("label"),
                    F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n"))
               .withColumn("rep", F.monotonically_increasing_id()))
    classes = materialize(classes, "classes")
    keyed = materialize(classes.mapInArrow(
        _key_batches(width), "rep long, n long, label long, vector binary, home array<long>, "
        "visit array<long>"), "cells")
    homes = keyed.select("rep", F.lit(True).alias("at_home"), F.posexplode("home").alias("t", "key"))
    visits = keyed.select("rep", F.lit(False).alias("at_home"),
                          F.posexplode("visit").alias("v", "key"))
    entries = materialize(homes.unionByName(visits.select(
        "rep", "at_home", F.floor(F.col("v") / PROBES).cast("int").alias("t"), "key")), "entries")
    # Cells where somebody is at home and not alone, and the parts they need.
    cells = (entries.groupBy("key").agg(F.count(F.lit(1)).alias("size"),
                                        F.max("at_home").alias("lived"))
             .where("size > 1 and lived")
             .select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    dealt = (entries.join(cells, "key").withColumn("own", own)
             .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("rep", "key", "t", "own", F.least("own", "q").alias("p"),
                     F.greatest("own", "q").alias("q")))
    met = (dealt.join(keyed, "rep").repartition("key", "p", "q")
           .sortWithinPartitions("key", "p", "q", "rep")
           .mapInArrow(_block_batches(width, cosine), "rep long, n long, c long"))
    links = materialize(met, "links")
    counts = links.groupBy("rep").agg(F.sum("n").alias("links"))
    parts = connected_components(
        links.where("c <> rep").select(F.col("rep").alias("a"), F.col("c").alias("b")).distinct()) \
        .select(F.col("id").alias("rep"), "component")
    # Only here a component takes the smallest id of its vectors as its name.
    grouped = materialize(classes.select("rep", "vec_id").join(parts, "rep"), "grouped")
    names = grouped.groupBy("component").agg(F.min("vec_id").alias("name"))
    named = grouped.join(names, "component").select("rep", "name")
    members = (classes.select("digest", "rep", "vec_id", "n").join(counts, "rep", "left")
               .join(named, "rep", "left")
               .select("digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                       F.coalesce("name", "vec_id").alias("component")))
    return (rows.select("vec_id", "digest").join(members, "digest", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
