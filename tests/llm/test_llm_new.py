"""Token counts, hard negatives and the Merkle manifest against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from recspark.llm import merkle, negatives, tokencount


def words(n, seed, pool=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(pool)}" for _ in range(n))



@pytest.fixture(scope="module")
def spec():
    import public_tokenizers
    return tokencount.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def library_counts(spec, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(spec)
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def counted(spark, spec, texts, **sizes):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = tokencount.count_tokens(df.repartition(3), spec, **sizes).collect()
    assert len(rows) == len(texts)
    return {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows}


def awkward_texts():
    r = random.Random(5)
    alphabet = ["a", "b", " ", "  ", "\n", "'", "re", "'s", "1", "22", "!", "?!", "é", "你", "好",
                "　", "<|endoftext|>", "<|endof", "text|>", " ", "🎉", "Word", " the"]
    out = ["".join(r.choice(alphabet) for _ in range(n)) for n in (3, 40, 300, 900, 2500, 2500)]
    out += ["x" * 900, "你好" * 400, "a" * 300 + " " + "b" * 700 + " c " * 30, " " * 700,
            "<|endoftext|>" * 60, words(400, 3), "", "\n" * 300 + "it's we'll they've " * 20]
    return out + [out[4], "'" * 500, "'re" * 300]


def test_counts_equal_the_library_for_every_cut(spark, spec):
    """Small pieces and overlaps, so all joints, widenings and cut-off tokens occur."""
    texts = awkward_texts()
    want = library_counts(spec, texts)
    for piece, overlap in ((64, 40), (50, 24), (128, 128), (33, 20)):
        got = counted(spark, spec, texts, long=piece, piece=piece, overlap=overlap, limit=100)
        for i, n in enumerate(want):
            assert got[i] == (len(texts[i].encode()), n, n > 100), (piece, overlap, i)


def test_counts_of_edge_rows(spark, spec, edge_docs, no_docs):
    rows = tokencount.count_tokens(edge_docs, spec, long=4096, piece=4096, overlap=512).collect()
    source = edge_docs.select("doc_id", "text").collect()
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, n, len((r["text"] or "").encode()))
                  for r, n in zip(source, library_counts(spec, [r["text"] or "" for r in source])))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_bytes"])
                  for r in rows) == want
    empty = tokencount.count_tokens(no_docs, spec)
    assert empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and not empty.collect()


def test_a_bad_vocabulary_is_refused(tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"normalizer": {"type": "NFC"}, "pre_tokenizer": {"type": "ByteLevel"}}')
    with pytest.raises(ValueError):
        tokencount.read_tokenizer(str(path))


VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("row", T.StringType()), T.StructField("part", T.StringType())])


def vector_rows(n, dim=12, seed=0, labels=4):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(labels, dim))
    rows = []
    for i in range(n):
        label = int(r.integers(labels)) if i % 3 else 0        # label 0 holds a third and more
        v = r.normal(size=dim) * 0.5 + centers[int(r.integers(labels))]
        rows.append((i, label, [float(x) for x in np.float32(v)], "r", "p"))
    rows += [(n + i, *rows[100][1:]) for i in range(40)]       # copies of an anchor's vector
    rows += [rows[200], (None, 1, [1.0] * dim, "r", "p"), (900_000, None, [1.0] * dim, "r", "p"),
             (900_100, 1, None, "r", "p"), (900_200, 1, [1.0, None] * (dim // 2), "r", "p"),
             (900_300, 1, [float("nan")] * dim, "r", "p"), (900_400, 1, [], "r", "p"),
             (900_500, 2, [0.0] * dim, "r", "p"), (900_600, 3, [0.5] * (dim - 5), "r", "p"),
             (900_601, 3, [0.4] * (dim - 5), "r", "p"), (900_602, 1, [0.45] * (dim - 5), "r", "p")]
    return rows


def brute_negatives(rows, low=80):
    ok = [(i, l, np.floor(np.array(v, np.float64) * 256)) for i, l, v, *_ in rows
          if i is not None and l is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for a, (i, l, v) in enumerate(ok):
        if i % 100:
            continue
        scores = [(-int(v @ w), j, m) for b, (j, m, w) in enumerate(ok)
                  if b != a and len(w) == len(v)]
        best = sorted((s, j) for s, j, m in scores if m == l)[:5]
        for p, pid in best:
            band = sorted((s, j) for s, j, m in scores
                          if m != l and low * -p <= 100 * -s <= 100 * -p)[:5]
            out += [(i, pid, r + 1, j, -p, -s) for r, (s, j) in enumerate(band)]
    return sorted(out)


def test_negatives_equal_brute_force(spark, monkeypatch):
    rows = vector_rows(1300)
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    want = brute_negatives(rows)
    assert len(want) > 100
    assert sorted(map(tuple, negatives.hard_negatives(df).collect())) == want
    monkeypatch.setattr(negatives, "PACK", 3)                  # many packs and blocks
    monkeypatch.setattr(negatives, "BLOCK", (100, 100))
    assert sorted(map(tuple, negatives.hard_negatives(df).collect())) == want


def test_negatives_of_an_empty_table(spark):
    df = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(df).collect() == []


def test_large_scores_are_exact():
    a = np.array([[2.0 ** 40 + 1, 3.0]])
    got = negatives.exact_scores(a, a, np.array([0]), np.array([0]))
    assert got[0] == 2 ** 62                                   # held at the limit
    b = np.array([[2.0 ** 30 + 1, 3.0]])
    assert negatives.exact_scores(b, b, np.array([0]), np.array([0]))[0] == (2 ** 30 + 1) ** 2 + 9


def test_segment_bounds_hold_and_refine():
    r = np.random.default_rng(1)
    q = np.floor(r.normal(size=(200, 64)).cumsum(axis=1) * 20)
    exact = q @ q.T
    width = []
    for s in negatives.LEVELS:
        m = negatives.summarise(q, s)
        low, up = negatives.bounds(m, m)
        assert (low <= exact).all() and (exact <= up).all()
        width.append((up - low).mean())
    assert width == sorted(width, reverse=True)


def test_the_filter_leaves_few_exact_scores():
    """On vectors whose neighbouring components are alike most pairs end at a bound."""
    r = np.random.default_rng(2)
    q = np.floor(np.repeat(r.normal(size=(4096, 16)), 4, axis=1) * 100
                 + r.normal(size=(4096, 64)) * 5)
    def block(x, start):
        return {"row": np.arange(start, start + len(x)), "id": np.arange(start, start + len(x)),
                "label": np.zeros(len(x), int), "q": x,
                "levels": [negatives.summarise(x, s) for s in negatives.LEVELS]}
    one = np.full((64, 1), negatives._BEYOND)
    pack = negatives.Pack(block(q[:64], 0), -one, one, 5, False)
    for at in range(0, len(q), 512):
        pack.add(block(q[at:at + 512], at))
    scores = q[:64] @ q.T
    np.fill_diagonal(scores, -np.inf)
    want = np.sort(scores, axis=1)[:, :-6:-1]
    assert (pack.best["score"].reshape(64, 5) == want).all()
    assert pack.scored < 64 * 4096 * 0.4


# --- Merkle -----------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path_of(levels, at):
    steps = []
    for nodes in levels[:-1]:
        run = nodes[at // 8 * 8:at // 8 * 8 + 8]
        steps.append((at % 8, run))
        at //= 8
    return steps


def brute_manifest(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    names = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in names:
        keyed = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])), i)
                       for i, r in enumerate(by_lang[lang]))
        trees[lang] = ([by_lang[lang][i] for _, i in keyed], levels_of([k[2] for k, _ in keyed]))
    top = levels_of([trees[lang][1][-1][0] for lang in names])
    root = top[-1][0]
    out = []
    for g, lang in enumerate(names):
        ordered, levels = trees[lang]
        for at, r in enumerate(ordered):
            steps = path_of(levels, at) + path_of(top, g)
            proof = sha("".join("".join(run[:k] + run[k + 1:]) for k, run in steps))
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h = leaf_of(r, text)
            for k, run in steps:
                h = sha("".join([*run[:k], h, *run[k + 1:]]))
            out.append((r["doc_id"], levels[0][at], levels[-1][0], root, proof, h, h == root))
    return sorted(out, key=str)


def many_docs(n):
    r = random.Random(4)
    langs = ["de"] * 5 + ["en", "fr", None, "", "zz"]
    rows = [(i, r.choice(["Some Text ", "no capitals ", ""]) + words(3, i), r.choice(langs),
             "src", i) for i in range(n)]
    return rows + [(n, None, "only", None, None)]


PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("n,levels", [(1, 4), (700, 4), (700, 1), (700, 2), (64, 2), (65, 1)])
def test_manifest_equals_brute_force(spark, n, levels):
    df = spark.createDataFrame(many_docs(n), PLAIN)
    got = merkle.merkle_manifest(df.repartition(4), levels=levels)
    assert sorted(map(tuple, got.collect()), key=str) == brute_manifest(df.collect())


def test_manifest_of_edge_rows(spark, edge_docs, no_docs):
    got = merkle.merkle_manifest(edge_docs, levels=1)
    assert sorted(map(tuple, got.collect()), key=str) == brute_manifest(edge_docs.collect())
    empty = merkle.merkle_manifest(no_docs)
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                             "verified"] and empty.collect() == []


def test_paths_lead_to_the_root(spark):
    df = spark.createDataFrame(many_docs(150), PLAIN)
    rows = merkle.merkle_manifest(df, detail=True, levels=1).collect()
    assert len(rows) == 151
    for r in rows:
        assert merkle.fold(r["leaf"], [(s["at"], s["run"]) for s in r["path"]]) == r["root"]


def test_witnesses_grow_with_later_appends():
    tree = merkle.OpenTree()
    first = tree.append(sha("0"))
    known = []
    for i in range(1, 600):
        tree.append(sha(str(i)))
        known.append(len(merkle.witness(first)))
    assert known[5:7] == [0, 1] and known[62] == 2 and known[-1] == 3
    assert sum(map(len, tree.open)) < 8 * len(tree.open)       # open runs only
    want = levels_of([sha(str(i)) for i in range(600)])
    root = tree.close()
    assert root.hash == want[-1][0]
    assert merkle.fold(first.hash, merkle.witness(first)) == root.hash
