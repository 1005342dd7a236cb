"""E8 lattice hashing against brute force."""

import numpy as np
import pytest
from recspark.llm import lattice
from recspark.llm.common import sorted_blocks

SCHEMA = "vec_id long, embedding array<float>, label int, extra string, kept int"


def brute(rows, cosine=lattice.MIN_COSINE):
    fit = {}
    for n, (i, e, label, *_) in enumerate(rows):
        if i is None or label is None or not e or any(x is None or not np.isfinite(x) for x in e):
            continue
        v = np.array(e, np.float32).astype(float)
        if v.any():
            fit[n] = (label, len(e), v / np.linalg.norm(v))
    links = {n: 0 for n in range(len(rows))}
    low = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    keys = sorted(fit)
    for a, x in enumerate(keys):
        for y in keys[a + 1:]:
            if fit[x][:2] == fit[y][:2] and fit[x][2] @ fit[y][2] >= cosine:
                links[x] += 1
                links[y] += 1
                p, q = sorted((find(rows[x][0]), find(rows[y][0])))
                low[q] = p
    return sorted((str(r[0]), links[n], None if r[0] is None else find(r[0]))
                  for n, r in enumerate(rows))


def rows_of(seed=2, dim=24, groups=40):
    r = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = r.normal(size=dim)
        for _ in range(r.integers(1, 9)):
            e = base + r.normal(size=dim) * r.choice([0, .05, .15, .25, .35])
            rows.append([float(np.float32(x)) for x in e * r.choice([.01, 1, 50])])
    out = [(i, e, int(i % 2), "x", 1) for i, e in enumerate(rows)]
    nan = float("nan")
    odd = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [nan] * dim,
           [float("inf")] + [0.0] * (dim - 1), [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0]]
    out += [(10_000 + i, e, 0, None, None) for i, e in enumerate(odd)]
    out += [(20_000, out[0][1], None, "x", 1), (None, out[0][1], 0, "x", 1)]
    out += [out[3], out[3]]                                     # repeated rows
    return out


@pytest.mark.parametrize("seed", [2, 3])
def test_links_equal_brute_force(spark, seed):
    rows = rows_of(seed)
    got = lattice.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    out = got.collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in out) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_one_id_with_two_vectors(spark):
    r = np.random.default_rng(6)
    a, b = ([float(np.float32(x)) for x in r.normal(size=24)] for _ in range(2))
    digests = {d["vec_id"]: d["digest"] for d in lattice.digest_vectors(spark.createDataFrame(
        [(0, a, 0, "x", 1), (1, b, 0, "x", 1)], SCHEMA))[0].collect()}
    if digests[0] > digests[1]:
        a, b = b, a                                            # b isn't the smaller digest
    near = [b[0] * 1.01, *b[1:]]
    rows = [(5, a, 0, "x", 1), (5, b, 0, "x", 1), (9, b, 0, "x", 1), (12, b, 0, "x", 1),
            (14, near, 0, "x", 1), (5, b, 1, "x", 1), (20, b, 1, "x", 1)]
    got = lattice.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(tuple(x) for x in got.collect()) == sorted([
        (5, 0, 5, True), (5, 3, 5, True), (9, 3, 5, False), (12, 3, 5, False), (14, 3, 5, False),
        (5, 1, 5, True), (20, 1, 5, False)])


def test_divided_cells_count_every_link_once(spark, monkeypatch):
    """A hot group of near copies in cells far larger than a block."""
    monkeypatch.setattr(lattice, "BLOCK", 16)
    r = np.random.default_rng(4)
    base = r.normal(size=16)
    rows = [(i, [float(np.float32(x)) for x in base + .03 * r.normal(size=16)], 1, None, None)
            for i in range(150)]
    rows += [(1000 + i, [float(np.float32(x)) for x in r.normal(size=16)], 1, None, None)
             for i in range(50)]
    got = lattice.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    out = sorted((str(x["vec_id"]), x["n_links"], x["component_id"]) for x in got.collect())
    assert out == brute(rows)


def test_recall_at_the_threshold():
    r = np.random.default_rng(0)
    a = lattice.unit_vectors(r.normal(size=(3000, 64)))
    b = r.normal(size=(3000, 64))
    b = lattice.unit_vectors(b - (a * b).sum(1, keepdims=True) * a)
    b = .93 * a + np.sqrt(1 - .93 ** 2) * b
    label = np.zeros(3000, np.int64)
    (ha, va), (hb, vb) = lattice.lattice_keys(a, label), lattice.lattice_keys(b, label)
    met = ((ha == hb) | (va == hb[:, :, None]).any(2) | (vb == ha[:, :, None]).any(2)).any(1)
    assert met.mean() > 0.99


def test_decoder_finds_the_nearest_point():
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 8)) * 2
    p = lattice.decode_e8(x)
    twice = np.rint(p * 2).astype(int)
    assert (twice == p * 2).all() and (np.ptp(twice % 2, axis=1) == 0).all()
    assert (np.rint(p.sum(1)) == p.sum(1)).all() and (np.rint(p.sum(1)).astype(int) % 2 == 0).all()
    short = lattice.minimal_vectors()
    assert len(short) == 240 and np.allclose((short ** 2).sum(1), 2)
    here = ((x - p) ** 2).sum(1)
    for v in short:                      # no neighbour is nearer
        assert (here <= ((x - p - v) ** 2).sum(1) + 1e-9).all()
    assert (here <= 1 + 1e-9).all()      # the lattice's covering radius is 1


def test_doubles_and_empty_tables(spark):
    big = [(0, [1e300, 1e300], 1), (1, [1e300, 0.99e300], 1), (2, [1e-300, -1e-300], 1)]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in
           lattice.near_duplicate_vectors(df).collect()}
    assert got == {0: (1, 0), 1: (1, 0), 2: (0, 2)}
    assert lattice.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sorted_blocks():
    import pyarrow as pa
    key = [1, 1, 2, 3, 3, 3, 3, 9]
    batches = [pa.RecordBatch.from_pydict({"k": key[a:b], "v": list(range(a, b))})
               for a, b in ((0, 1), (1, 5), (5, 5), (5, 8))]
    got = [b.to_pydict() for b in sorted_blocks(iter(batches), ("k",), step=2)]
    assert [g["k"] for g in got] == [[1, 1], [2], [3, 3, 3, 3], [9]]
    assert [x for g in got for x in g["v"]] == list(range(8))
    assert list(sorted_blocks(iter([]), ("k",))) == []


@pytest.mark.parametrize("collide", [False, True])
def test_labels_never_meet(spark, monkeypatch, collide):
    """Labels that differ by multiples of any step, in all tables; and cells whose keys
    collide over labels, lengths and tables are compared apart."""
    r = np.random.default_rng(5)
    base = r.normal(size=(12, 16))
    labels = [0, 7919, 15838, -7919, -1, 1000003, 2 ** 40, 5 * 7919]
    rows = []
    for n in range(240):
        dim = 16 if n % 9 else 11
        e = base[n % 12][:dim] + r.normal(size=dim) * 0.02
        rows.append((n, [float(np.float32(x)) for x in e], labels[n % 8], "x", 1))
    schema = SCHEMA.replace("label int", "label long")
    if collide:
        plain = lattice._cell_key
        monkeypatch.setattr(lattice, "_cell_key",
                            lambda points, salt: plain(points, np.zeros_like(salt)) % 50)
    got = lattice.near_duplicate_vectors(spark.createDataFrame(rows, schema).repartition(3))
    assert sorted((str(x.vec_id), x.n_links, x.component_id) for x in got.collect()) == brute(rows)


def test_large_blocks_are_whole(monkeypatch):
    """Beyond the limit a block's columns get 64-bit offsets, and no row is lost."""
    import pyarrow as pa
    from recspark.llm import common
    monkeypatch.setattr(common, "SMALL_BLOCK", 100)
    batches = [pa.RecordBatch.from_arrays(
        [pa.array([k] * 5), pa.array([bytes([k]) * 50] * 5, pa.binary()),
         pa.array(["t" * 30] * 5)], ["key", "b", "t"]) for k in (1, 1, 2)]
    blocks = list(sorted_blocks(iter(batches), ("key",)))
    assert [b.num_rows for b in blocks] == [10, 5]
    assert blocks[0].schema.field("b").type == pa.large_binary()
    assert blocks[0].column("b").to_pylist() == [b"\x01" * 50] * 10
