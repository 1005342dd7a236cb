"""Quality, SetSketch, language, BPE and PII against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import edge_rows, words
from pyspark.sql import functions as F
from recspark.llm import bpe, components, langid, pii, quality, setsketch
from recspark.llm.queries import vocabulary_path
from recspark.llm.text_arrays import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- quality ---------------------------------------------------------------------

def brute_base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit))


def test_statistics_equal_brute_force():
    r = random.Random(1)
    texts = [x[1] for x in edge_rows()] + [
        "".join(r.choice(["a", "b", "B", "é", " ", "\n", "\t", "#", "\U0001F389", " a b", "\x0b"])
                for _ in range(r.randrange(60))) for _ in range(300)]
    base, x = quality.statistics(pa.array(texts))
    got = list(zip(*(base[k].tolist() for k in quality.BASE)))
    assert got == [brute_base(t) for t in texts]
    assert np.isfinite(x).all()


def test_trees_learn_and_keep_directions():
    r = np.random.default_rng(0)
    x = r.random((1500, 3))
    y = ((x[:, 0] + x[:, 1] + 0.3 * np.sin(20 * x[:, 1]) + r.normal(0, .1, 1500)) > 1).astype(float)
    t = quality.fit_trees(x[:1000], y[:1000], [1, 0, -1], trees=40)
    assert ((t.probability(x[1000:]) > .5) == y[1000:]).mean() > .9
    grid = np.tile(x[:100], (50, 1))
    for f, sign in ((0, 1), (2, -1)):
        g = grid.copy()
        g[:, f] = np.repeat(np.linspace(0, 1, 50), 100)
        p = t.raw(g).reshape(50, 100)
        assert (sign * np.diff(p, axis=0) >= -1e-9).all()


def test_quality_operator(spark, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0), 0) for i in range(14)] + [(3, None, 0), (None, 1, 0), (5, 0, 0)],
        "doc_id long, quality int, toxic int")
    model = quality.fit_quality(edge_docs, labels)
    rows = quality.score_documents(edge_docs, model).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(
        (r["doc_id"], r["text"]) for r in edge_docs.collect())
    for r in rows:
        b = brute_base(r["text"])
        assert tuple(r[k] for k in quality.BASE) == b
        assert r["base_failed"] == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= quality.THRESHOLD)
    kept = quality.keep_good_documents(edge_docs, model)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r["kept"] for r in rows)
    none = quality.fit_quality(no_docs, labels.limit(0))
    out = quality.score_documents(edge_docs, none, keep_columns=False).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in out)
    assert quality.score_documents(no_docs, none).count() == 0


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(
        f"{d}/labels.parquet")
    train = labels.where("doc_id % 2 = 0")
    model = quality.fit_quality(docs, train)
    held = quality.score_documents(docs, model, keep_columns=False).select(
        "doc_id", (F.col("quality") >= 0.5).alias("good")).join(
        labels.where("doc_id % 2 = 1 and quality is not null"), "doc_id")
    right = held.agg(F.avg((F.col("good") == (F.col("quality") > 0)).cast("int"))).first()[0]
    assert right > 0.97


# --- near duplicates ---------------------------------------------------------------

def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    low = {i: i for i in ids}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                low[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def planted(seed=4):
    """Copies, near copies at all distances, chains and very short texts."""
    r = random.Random(seed)
    rows = []
    for g in range(12):
        base = words(r.choice([3, 6, 12, 40, 200]), 1000 * seed + g, 5000).split(" ")
        for _ in range(r.randrange(1, 9)):
            w = list(base)
            for _ in range(r.randrange(0, 1 + len(w) // 12)):
                w[r.randrange(len(w))] = f"n{r.randrange(10 ** 6)}"
            if r.random() < .3:
                base = w                         # a chain: the next comes from this one
            rows.append("\t".join(w).upper() if r.random() < .2 else " ".join(w))
    rows += ["", None, "  \n", "a b", "A  b", "a b c"]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [4, 5])
def test_components_equal_brute_force(spark, seed):
    rows = planted(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in setsketch.near_duplicates(docs).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in brute_components(rows).items()}


def test_near_duplicates_of_awkward_rows(spark, edge_docs, no_docs):
    rows = setsketch.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    want = brute_components([(r["doc_id"], r["text"]) for r in edge_docs.collect()
                             if r["doc_id"] is not None])
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    left = setsketch.drop_near_duplicates(edge_docs)
    assert left.columns == edge_docs.columns
    assert left.count() == sum(r["kept"] for r in rows)
    assert setsketch.near_duplicates(no_docs).count() == 0


def test_one_id_with_two_texts(spark):
    a, b, c = words(40, 801), words(40, 802), words(40, 803)
    digest = {x: setsketch._digest(Texts(pa.array([x]), lower=True).shingle_sets(5)[0])
              for x in (a, b)}
    a, b = sorted((a, b), key=digest.get)                      # b isn't the smaller digest
    near = b.rsplit(" ", 1)[0]
    rows = [(5, a), (5, b), (9, b), (12, b), (14, near), (3, c), (7, c), (7, words(40, 804))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r["doc_id"], r["component_id"], r["kept"])
                  for r in setsketch.near_duplicates(docs).collect())
    assert got == Counter([(5, 5, True), (5, 5, True), (9, 5, False), (12, 5, False),
                           (14, 5, False), (3, 3, True), (7, 3, False), (7, 7, True)])
    left = Counter(tuple(r) for r in setsketch.drop_near_duplicates(docs).collect())
    assert left == Counter([rows[0], rows[1], rows[5], rows[7]])


def test_sketch_estimates_and_merges():
    r = np.random.default_rng(2)
    for j, n in ((.9, 2000), (.75, 300), (.5, 1000), (.1, 500)):
        both = int(round(2 * n * j / (1 + j)))
        pool = r.integers(0, 2 ** 63, 4 * n).astype(np.uint64)
        a, b = pool[:n], np.concatenate([pool[:both], pool[n:2 * n - both]])
        ka, kb, ku = setsketch.sketch_sets([a, b, np.union1d(a, b)])
        est = setsketch.estimate_jaccard(ka[None], kb[None], np.array([n * 1.0]),
                                         np.array([n * 1.0]))[0]
        assert abs(est - j) < .13
        assert (setsketch.merge_sketches(ka, kb) == ku).all()


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (200, 201)]
    got = dict(components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect())
    want = {**{i: 1 for i in range(1, 41)}, 100: 90, 90: 90, 95: 90, 200: 200, 201: 200}
    assert got == want


# --- languages -------------------------------------------------------------------

def test_language_vectors_equal_their_definition():
    text = "Ab  c1é"
    got, has = langid.Profiler().vectors([text, None, "12 \n"])
    s = " ab c é "
    v = {c: langid.letter_vectors(np.array([ord(c)]))[0].astype(int) for c in s}
    want = sum(np.roll(v[s[i]], 2) * np.roll(v[s[i + 1]], 1) * v[s[i + 2]]
               for i in range(len(s) - 2))
    assert (got[0] == want).all() and has.tolist() == [True, False, False]
    assert not got[1].any()


def test_language_operator(spark, edge_docs, no_docs):
    rows = langid.identify_languages(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    text = {(r["doc_id"], r["text"]) for r in edge_docs.collect()}
    und = {i for i, t in text if not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == und
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert langid.identify_languages(no_docs).count() == 0
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify_languages(unlabelled).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = langid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.where("held_out and lang is not null").agg(
        F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_model_ignores_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = docs.withColumn("lang", F.when(langid.id_bucket() == 1, F.lit("xx"))
                           .otherwise(F.col("lang")))
    a, b = langid.learn_prototypes(docs), langid.learn_prototypes(held)
    assert sorted(a) == sorted(b) and all((a[k] == b[k]).all() for k in a)


# --- BPE -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary_path())
    t.no_padding()
    t.no_truncation()
    return t


def random_texts(n=1500):
    r = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "a", "B", "'s", "'ll", "é", "1", "٣", "!", "<|endoftext|>",
            "<|endof", "\x1c", "\x85", "\xa0", "​", "你", "\U0001F389", "don't", " ' ", "\0"]
    out = []
    for _ in range(n):
        k = r.random()
        if k < .4:
            out.append("".join(chr(r.choice([r.randrange(1, 0x250), r.randrange(0x2000, 0x3100),
                                             r.randrange(0x10000, 0x1FFFF)]))
                               for _ in range(r.randrange(60))))
        elif k < .8:
            out.append("".join(r.choice(bits) for _ in range(r.randrange(40))))
        else:
            out.append("".join(r.choice("abcdefghij") for _ in range(r.randrange(200))))
    return out + ["", "a" * 5000, "ab" * 3000, " " * 300, "\n\n \n", "é" * 25, "x" * 48, "x" * 49]


def test_bpe_equals_the_library(vocabulary, library):
    texts = random_texts()
    t = bpe.Tokenizer(vocabulary)
    for text, ids, want in zip(texts, t.encode(texts),
                               library.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == want.ids, text
        assert t.decode(ids.tolist()) == library.decode(want.ids, skip_special_tokens=False)


def test_bpe_cache_bound_and_long_words(vocabulary, monkeypatch):
    texts = random_texts(300)
    want = [i.tolist() for i in bpe.Tokenizer(vocabulary).encode(texts)]
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 10)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 100)
    monkeypatch.setattr(bpe, "SHORT", 4)
    assert [i.tolist() for i in bpe.Tokenizer(vocabulary).encode(texts)] == want


def test_bpe_decodes_any_ids(vocabulary, library):
    r = random.Random(2)
    t = bpe.Tokenizer(vocabulary)
    for _ in range(300):
        ids = [r.randrange(vocabulary.size) for _ in range(r.randrange(12))]
        assert t.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_operator(edge_docs, no_docs, vocabulary):
    rows = bpe.encode_documents(edge_docs, vocabulary).collect()
    t = bpe.Tokenizer(vocabulary)
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(
        (r["doc_id"], r["text"]) for r in edge_docs.collect())
    for r in rows:
        ids = r["token_ids"]
        assert r["n_tokens"] == len(ids) and t.decode(ids) == (r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.encode_documents(no_docs, vocabulary, with_ids=False).count() == 0


# --- PII -------------------------------------------------------------------------

PATTERNS = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text):
            g = m.group()
            d = re.sub("[^0-9]", "", g)
            total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c)
                        for i, c in enumerate(reversed(d)))
            if (k == 1 and max(map(int, g.split("."))) > 255
                    or k == 2 and not (12 <= len(d) <= 19 and total % 10 == 0)
                    or k == 3 and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def test_base_spans_equal_the_patterns():
    r = random.Random(2)
    for _ in range(20_000):
        t = "".join(r.choice("ab.@@12 3-+()._ 0%é") for _ in range(r.randrange(80)))
        assert pii.base_spans(t) == brute_spans(t), t
    for t in ("4 111-1111 11111111 11", "1.2.3.4.5.6.7.8", "a@b.c@d.e", "+1(2)3.4-5 67890",
              "00000.1.2.3", "4111111111111111" * 3):
        assert pii.base_spans(t) == brute_spans(t)


def test_network_gradients():
    r = np.random.default_rng(3)
    n = pii.new_network(kind=np.float64)
    codes, tags = r.integers(0, 131, (20, 3)), np.zeros((20, 3), int)
    tags[3:7, 0] = [1, 2, 2, 2]
    tags[9:12, 1] = [5, 6, 6]
    loss, g = pii.gradients(n, codes, tags)
    for name in n.NAMES:
        a = getattr(n, name)
        i = np.unravel_index(np.abs(g[name]).argmax(), a.shape)
        a[i] += 1e-5
        more, _ = pii.gradients(n, codes, tags)
        a[i] -= 1e-5
        assert abs((more - loss) / 1e-5 - g[name][i]) < 1e-3 * max(1, abs(g[name][i]))


def test_viterbi_equals_brute_force():
    from itertools import product
    r = np.random.default_rng(5)
    n = pii.new_network(kind=np.float64)
    n.trans += r.normal(size=n.trans.shape)
    e = r.normal(size=(4, 1, pii.N_TAGS)) * 2
    tr = n.trans + np.where(pii._allowed(), 0, -1e4)
    best = max(product(range(pii.N_TAGS), repeat=4), key=lambda p: e[range(4), 0, p].sum()
               + n.first[p[0]] + sum(tr[a, b] for a, b in zip(p, p[1:])))
    assert pii.viterbi(n, e)[:, 0].tolist() == list(best)


@pytest.fixture(scope="module")
def network(spark):
    return pii.fit_network(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def held_out_texts(spark):
    rows = (spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
            .where(F.col("text").rlike("[0-9@]")).select("text").collect())
    return [r["text"] for r in rows]


def test_network_finds_what_the_patterns_miss(spark, network):
    found = total = 0
    for n, text in enumerate(held_out_texts(spark)):
        spans = pii.base_spans(text)
        if not spans:
            continue
        s, e, k = spans[0]
        new = pii._rewrite(text[s:e], k, n)
        other = text[:s] + new + text[e:]
        (base, added), = pii.find_spans([other], network)
        total += 1
        found += (s, s + len(new), k) in base + added
    assert total >= 40 and found >= 0.8 * total


def test_network_leaves_clean_text_alone(spark, network):
    clean = [re.sub(r"[0-9@+]+", "", t) for t in held_out_texts(spark)]
    clean += [words(80, i).replace("w", "On ") + " Version 2.0 of 2021-03-04, 3.14 or 17%"
              for i in range(30)]
    added = [a for _, a in pii.find_spans(clean, network)]
    assert sum(map(len, added)) == 0


def test_skipped_windows_change_nothing(spark, network, monkeypatch):
    texts = held_out_texts(spark)[:12]
    want = list(pii.find_spans(texts, network))
    monkeypatch.setattr(pii, "window_starts",
                        lambda t: list(range(0, max(len(t) - pii.STRIDE, 1), pii.STRIDE)))
    assert list(pii.find_spans(texts, network)) == want


def test_pii_operator(edge_docs, no_docs, network):
    rows = pii.find_personal_data(edge_docs, network).collect()
    want = Counter()
    for r in edge_docs.collect():
        b = pii.spans_text(brute_spans(r["text"] or ""))
        want[r["doc_id"], hashlib.sha256(b.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["base_sha256"]) for r in rows) == want
    masked = {r["doc_id"]: r["text"] for r in pii.mask_personal_data(edge_docs, network).collect()}
    assert masked[12] == "mail [email] or [ip] now" and masked[1] is None
    assert pii.find_personal_data(no_docs, network).count() == 0
    assert pii.fit_network(no_docs) is None
    assert pii.find_personal_data(edge_docs, None).count() == edge_docs.count()


# --- byte arrays -----------------------------------------------------------------

def test_shingle_sets_equal_brute_force():
    texts = [x[1] for x in edge_rows()] + ["a b", " a\tb ", "A B", "a b c d e", "a b c d e f"]
    sets = Texts(pa.array(texts), lower=True).shingle_sets(5)
    want = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(i):
            assert (len(np.intersect1d(sets[i], sets[j])) == len(want[i] & want[j]))
    part = pa.array([None, "zz", *texts])[2:]                  # a slice with an offset
    again = Texts(part, lower=True).shingle_sets(5)
    assert all((a == b).all() for a, b in zip(sets, again))


def _pairs_without_a_band(small, large, n, seed):
    """Of n pairs of sets, one inside the other, those whose sketches share no band."""
    r = np.random.default_rng(seed)
    lost = 0
    for _ in range(0, n, 5000):
        big = r.integers(0, 2 ** 63, size=(5000, large)).astype(np.uint64)
        keys = [setsketch.band_keys(setsketch.sketch_sets([np.sort(x) for x in part]))
                for part in (big[:, :small], big)]
        lost += int((~(keys[0] == keys[1]).any(axis=1)).sum())
    return lost


@pytest.mark.parametrize("small,large", [(3, 4), (6, 8)])
def test_tiny_sets_at_the_threshold_meet(small, large):
    """100,000 pairs at a similarity of exactly 0.75; independent registers lose 1e-6."""
    assert _pairs_without_a_band(small, large, 100_000, 9) <= 2


def test_blocks_follow_the_bytes_of_their_sets(spark, monkeypatch):
    """With a low limit of rows and bytes every pair is its own block: same result."""
    texts = [" ".join(f"w{i}" for i in range(60))]
    r = np.random.default_rng(3)
    for n in range(40):
        words_ = texts[0].split()
        for at in r.integers(0, 60, size=2):
            words_[at] = f"x{n}"
        texts.append(" ".join(words_))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(map(tuple, setsketch.near_duplicates(docs).collect()))
    monkeypatch.setattr(setsketch, "BLOCK_BYTES", 500)
    monkeypatch.setattr(setsketch, "ROUNDS", 0)
    assert sorted(map(tuple, setsketch.near_duplicates(docs).collect())) == want


def test_many_letters_are_bound_in_slices(monkeypatch):
    """350,000 letters of a large alphabet: the same sums, in bounded memory."""
    import tracemalloc
    r = np.random.default_rng(1)
    texts = ["".join(map(chr, r.integers(0x4E00, 0x9F00, n))) for n in (350_000, 300, 0, 40)]
    profiler = langid.Profiler()
    tracemalloc.start()
    got, has = profiler.vectors(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20
    assert has.tolist() == [True, True, False, True]
    doc, runs, _ = langid.letter_runs(texts)
    for d in (1, 3):
        assert (got[d] == langid.run_vectors(runs[doc == d]).astype(int).sum(0)).all()
    some = texts[0][:30_000]
    monkeypatch.setattr(langid, "_CACHE_RUNS", 1 << 30)
    whole = langid.Profiler().vectors([some, texts[1]])[0]
    monkeypatch.setattr(langid, "_CACHE_RUNS", 100)
    monkeypatch.setattr(langid, "_SLICE", 777)
    assert (langid.Profiler().vectors([some, texts[1]])[0] == whole).all()


def _reconcile_by_definition(text, found, base):
    """Each span against each other one."""
    whole = [f for f in found if not (f[4] or f[5])]
    for f in sorted(f for f in found if (f[4] or f[5]) and not any(
            w[2] == f[2] and w[0] < f[1] and f[0] < w[1] for w in whole)):
        if whole and whole[-1][2] == f[2] and f[0] <= whole[-1][1] and any(whole[-1][4:]):
            a = whole.pop()
            f = (min(a[0], f[0]), max(a[1], f[1]), f[2], min(a[3], f[3]), a[4], True)
        whole.append(f)
    taken, out = [x[:2] for x in base], []
    for s, e, kind, score, *_ in sorted(whole, key=lambda f: (-f[3], f[0], f[2], -f[1])):
        while s < e and text[s] in " .,;:":
            s += 1
        while e > s and text[e - 1] in " .,;:":
            e -= 1
        if (score >= pii.MIN_SCORE and pii._TRIGGER.search(text[s:e])
                and pii._PLAUSIBLE[kind](text[s:e])
                and not any(a < e and s < b for a, b in taken)):
            taken.append((s, e))
            out.append((s, e, kind))
    return out


def test_spans_are_reconciled_as_defined():
    import random
    r = random.Random(6)
    for _ in range(300):
        text = "".join(r.choice("01234567890123 .@ab+-()") for _ in range(300))
        found = []
        for _ in range(60):
            s = r.randrange(290)
            found.append((s, min(300, s + r.randrange(1, 40)), r.randrange(4),
                          r.choice([0.5, 0.7, 0.8, 0.9, 0.95]), r.random() < .2, r.random() < .2))
        base = [(s, s + r.randrange(5, 30), r.randrange(4)) for s in r.sample(range(270), 4)]
        assert pii.reconcile(text, found, base) == _reconcile_by_definition(text, found, base)


def test_four_megabytes_of_telephone_numbers():
    """Every span seen by two windows, and all of them cut for training, in linear time."""
    import time
    line = "(212) 555-0143 +1 212 555 0199\n"
    text = line * ((4 << 20) // len(line))
    found = []
    for at in range(0, len(text), len(line)):
        found += [(at, at + 14, 3, 0.9, False, False)] * 2
    base = [(at + 15, at + 30, 3) for at in range(0, len(text), len(line))]
    began = time.time()
    assert len(pii.reconcile(text, found, base)) == len(base)
    assert time.time() - began < 60
    began = time.time()
    n = sum(1 for _ in zip(range(20_000), pii.training_windows(text)))
    assert n == 20_000 and time.time() - began < 60
