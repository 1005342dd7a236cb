"""Sharding, mixing, line de-duplication and chat windows against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from recspark.llm import chat, linededup, mixing, sharding

SPACE = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- sharding --------------------------------------------------------------------

def brute_shard(key, weights):
    def score(i):
        u = (int(hashlib.md5(f"{i}|{key}".encode()).hexdigest()[:13], 16) + .5) / 16 ** 13
        return math.log(u) / weights[i]
    return max(range(len(weights)), key=lambda i: (score(i), -i))


def test_shards_equal_brute_force(spark, edge_docs):
    rows = sharding.shard_documents(edge_docs, [1.0] * 8).collect()
    want = edge_docs.collect()
    assert len(rows) == len(want)
    by_row = Counter()
    for r in want:
        t = (r["text"] or "").encode()
        key = "null" if r["doc_id"] is None else f"k{r['doc_id']}"
        by_row[r["doc_id"], len(t) + 1, zlib.crc32(t), brute_shard(key, [1.0] * 8),
               brute_shard(key, [1.0] * 9)] += 1
    assert by_row == Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"],
                              r["grown_shard"]) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_more_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(5000).select(F.col("id").alias("doc_id"))
    old = sharding.assign_shards(ids, "doc_id", [1.0] * 8)
    new = sharding.assign_shards(old, "doc_id", [1.0] * 9, "grown")
    assert new.where("grown <> shard and grown <> 8").count() == 0
    moved = new.where("grown <> shard").count()
    assert 0.8 * 5000 / 9 < moved < 1.2 * 5000 / 9


def test_shard_weights(spark):
    ids = spark.range(6000).select(F.col("id").alias("doc_id"))
    got = dict(sharding.assign_shards(ids, "doc_id", [1.0, 2.0, 3.0]).groupBy("shard").count()
               .collect())
    assert all(abs(got[i] - 1000 * (i + 1)) < 130 for i in range(3))


def test_slots_of_equal_rows_and_many_groups(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_GROUP_ROWS", 7)
    monkeypatch.setattr(sharding, "COPY_CHUNK", 5)
    df = spark.range(60).select((F.col("id") % 20).alias("a"), F.lit(1).alias("shard"))
    df = df.union(spark.range(13).select(F.lit(99).cast("long"), F.lit(1)))
    got = sorted(r["slot"] for r in sharding.with_slots(df, "shard").collect())
    assert got == list(range(73))


def test_sharding_of_nothing(no_docs):
    assert sharding.shard_documents(no_docs, [1.0] * 8).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(no_docs, "doc_id", [])


# --- mixing ----------------------------------------------------------------------

def brute_copies(rows, weights, other, epochs):
    def stratum(r):
        return r["source"] if r["source"] in weights else None
    n = Counter(stratum(r) for r in rows)
    goal = {s: weights.get(s, other) for s in n}
    out = Counter()
    for r in rows:
        s = stratum(r)
        rate = epochs * len(rows) * goal[s] / sum(goal.values()) / n[s]
        key = (str(r["doc_id"]) if r["doc_id"] is not None
               else "t" + hashlib.md5((r["text"] or "").encode()).hexdigest())
        u = (int(hashlib.md5(f"mix|{key}".encode()).hexdigest()[:13], 16) + .5) / 16 ** 13
        k, p = 0, math.exp(-rate)
        c = p
        while c <= u:
            k += 1
            p *= rate / k
            c += p
        for copy in range(k):
            out[r["doc_id"], r["text"], copy, k] += 1
    return out


@pytest.mark.parametrize("epochs", [1.0, 4.0])
def test_copies_equal_brute_force(edge_docs, epochs):
    weights = {"hot": 1.0, "src1": 3.0, "absent": 5.0}
    got = mixing.mix_sources(edge_docs, weights, 2.0, epochs, detail=True)
    assert Counter((r["doc_id"], r["text"], r["copy"], r["n_copies"]) for r in got.collect()) \
        == brute_copies(edge_docs.collect(), weights, 2.0, epochs)


def test_mixing_keeps_columns_and_order(edge_docs, no_docs):
    got = mixing.mix_sources(edge_docs, {"hot": 1.0})
    assert got.columns == edge_docs.columns
    keys = [r["mix_key"] for r in mixing.mix_sources(edge_docs, {"hot": 1.0}, epochs=9.0,
                                                     detail=True).collect()]
    assert keys == sorted(keys) and len(keys) > 50
    assert mixing.mix_sources(no_docs, {"hot": 1.0}).count() == 0


def test_target_shares_are_met(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"),
        F.when(F.col("id") % 10 < 8, "big").otherwise("small").alias("source"))
    got = dict(mixing.mix_sources(docs, {"big": 1.0, "small": 1.0}).groupBy("source").count()
               .collect())
    assert abs(got["big"] - 10_000) < 400 and abs(got["small"] - 10_000) < 500


def test_large_means_are_sums_of_parts(spark, monkeypatch):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"),
        F.when(F.col("id") < 4, "rare").otherwise("big").alias("source"))
    monkeypatch.setattr(mixing, "MAX_MEAN", 8.0)
    monkeypatch.setattr(mixing, "COPY_CHUNK", 7)
    rows = mixing.mix_sources(docs, {"rare": 1.0, "big": 1.0}, epochs=40.0, detail=True).collect()
    copies = defaultdict(list)
    for r in rows:
        copies[r["doc_id"]].append(r["copy"])
        assert r["n_copies"] > r["copy"]
    assert all(sorted(c) == list(range(len(c))) for c in copies.values())
    # 4 documents of mean 2,000 and 396 of mean 20.2: five standard deviations
    rare = [len(copies[i]) for i in range(4)]
    assert abs(sum(rare) - 8000) < 5 * 8000 ** .5 and len(set(rare)) > 1
    assert abs(len(rows) - sum(rare) - 8000) < 5 * 8000 ** .5


def test_plan_does_not_grow_with_the_rate(spark):
    docs = spark.range(50_000).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"),
        F.when(F.col("id") == 0, "rare").otherwise("big").alias("source"))
    plan = mixing.mix_sources(docs, {"rare": 1.0, "big": 1.0})._jdf.queryExecution()
    assert len(plan.analyzed().toString()) < 100_000


def test_a_third_of_the_rows_on_one_id(spark):
    docs = spark.range(0, 9_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("doc_id"),
        F.lit("same text").alias("text"), F.lit("s").alias("source"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = mixing.mix_sources(docs, {}, epochs=3.0, detail=True)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        keys = [r["mix_key"] for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert keys == sorted(keys) and len(sizes) > 4
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


# --- lines -----------------------------------------------------------------------

def brute_lines(rows, min_chars=40, min_docs=5):
    held = defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            k = line.strip(SPACE).translate(LOW)
            if len(k) >= min_chars:
                held[k].add(r["doc_id"])
    keep = {k: max(x for x in s if x is not None) for k, s in held.items() if len(s) >= min_docs}
    out = Counter()
    for r in rows:
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines
                if keep.get(x.strip(SPACE).translate(LOW), r["doc_id"]) == r["doc_id"]]
        out[r["doc_id"], len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_lines_equal_brute_force(edge_docs):
    got = linededup.dedup_lines(edge_docs, detail=True).collect()
    want = brute_lines(edge_docs.collect())
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in got) == want
    assert sum(k[2] for k in want) >= 6


def test_random_lines_and_bitmaps(spark):
    r = random.Random(5)
    pool = [f"{i} " + "line that is long enough to be a key" * 2 for i in range(12)]
    rows = [(i, "\n".join(r.choice(pool + ["short"]) for _ in range(r.randrange(1, 25))))
            for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = linededup.dedup_lines(docs, min_docs=3, detail=True).collect()
    want = brute_lines(docs.collect(), min_docs=3)
    assert Counter((x["doc_id"], x["n_lines"], x["n_dropped"], x["text"]) for x in got) == want
    for x in got:
        runs = x["keep_runs"] or []
        assert sum(runs[1::2]) == x["n_dropped"] and sum(runs) <= x["n_lines"]
        assert all(n > 0 for n in runs[1:])


def test_hot_line(spark):
    line = "a line that stands in every single document of this table"
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.concat(
        F.lit(line + "\n"), F.col("id").cast("string"), F.lit("\n" + line)).alias("text"))
    got = linededup.dedup_lines(docs, detail=True)
    assert got.agg(F.sum("n_dropped")).first()[0] == 2 * 899
    assert got.where("n_dropped = 0").select("doc_id").first()[0] == 899


def test_hot_line_stays_spread(spark):
    line = "a line that stands in every single document of this table"
    docs = spark.range(0, 6_000, 1, 6).select(
        F.when(F.col("id") % 6 > 0, F.col("id")).alias("doc_id"),
        F.concat(F.lit(line + "\n"), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        occ = linededup.materialize(linededup.line_occurrences(docs), "lines").cache()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    keys = linededup.repeated_keys(occ)
    met = occ.join(keys, ["part", "h1", "h2"])
    assert met.count() == 6_000 and keys.select("h1").distinct().count() == 1
    assert keys.count() > 2
    assert met.groupBy("part").count().agg(F.max("count")).first()[0] < 6_000 / 2
    # all rows without an id are one document, whatever their texts
    assert linededup.repeated_keys(occ, 5_001).count() > 0
    assert linededup.repeated_keys(occ, 5_002).count() == 0
    occ.unpersist()
    got = linededup.dedup_lines(docs, detail=True)
    assert got.agg(F.sum("n_dropped")).first()[0] == 5_999


def test_lines_of_nothing(no_docs, edge_docs):
    assert linededup.dedup_lines(no_docs).count() == 0
    out = linededup.dedup_lines(edge_docs)
    assert out.columns == edge_docs.columns
    bad = out.where("text is not null and n_chars <> char_length(text)")
    assert bad.count() == 0


# --- chat ------------------------------------------------------------------------

def digests(turns):
    convs = defaultdict(list)
    for r in turns:
        convs[r[0]].append(r[1:])
    out = {}
    for c, ts in convs.items():
        ts.sort(key=lambda t: tuple((x is not None, x) for x in t))
        ts = [(r or "", x or "") for _, r, x in ts]
        loss = "".join(x for r, x in ts if r == "assistant")
        out[c] = (len(ts), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in ts).encode())
                  .hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def awkward_turns():
    r = random.Random(3)
    bits = ["<|im_end|>", "<|im_start|>", "assistant", "\n", "<\\|", "<\\\\|", "\\", "<", "|", "<n|",
            "é", "\U0001F389", "word ", "<|", "|>", "$1", " "]
    turns = []
    for c in range(60):
        for t in range(r.randrange(1, 14)):
            role = r.choice(["user", "assistant", "assistant", "system"]) if t else r.choice(
                ["system", "user", "assistant"])
            text = "".join(r.choice(bits) for _ in range(r.randrange(30))) + "x" * r.choice(
                [0, 10, 300, 900, 3000])
            turns.append((c, t, role, text))
    turns += [(None, 0, "user", "a"), (None, 1, "assistant", None), (900, 0, None, "x"),
              (900, 1, "we\nird <n| <|im_end|>\\", "y"), (901, 0, "assistant", ""),
              (902, None, "user", "q"), (902, 0, "user", "q"), (902, 0, "user", "q"),
              (903, 0, "system", "s" * 9000), (903, 1, "assistant", "t" * 9000),
              (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"),
              (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    return turns


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("budget,turns,tokens", [(512, 2, 128), (40, 3, 30), (1, 0, 0),
                                                 (10 ** 6, 2, 128)])
def test_windows_read_back(spark, budget, turns, tokens):
    rows = awkward_turns()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    w = chat.format_windows(df, budget, turns, tokens)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
           for r in chat.conversation_digests(w).collect()}
    assert got == digests(rows)
    for r in w.collect():
        assert r["text"].count("<|im_start|>") == r["n_turns"] == r["text"].count("<|im_end|>\n")
        # only a window of one new turn, without history, may be too large
        if r["over_budget"]:
            first = r["text"].startswith("<|im_start|>system")
            assert r["n_turns"] - r["n_repeated"] <= 1 + first and r["n_repeated"] <= first
        for s in r["loss_spans"]:
            assert r["text"][:s["start"]].endswith("<|im_start|>assistant\n")


def brute_windows(rows, budget, turns, tokens):
    """Sorted (conv_id, window, n_repeated, n_turns, tokens)."""
    convs = defaultdict(list)
    for c, *rest in rows:
        convs[c].append(rest)
    out = []
    for c, ts in convs.items():
        ts.sort(key=lambda t: tuple((x is not None, x) for x in t))
        tok = [-(-len((x or "").encode()) // 4) + chat.FRAME_TOKENS for _, _, x in ts]
        has_sys = ts[0][1] == "system"
        sys = tok[0] if has_sys else 0
        used, w, seen = 0, 0, [0, 0]
        for i, t in enumerate(tok):
            if i and used + t > budget:
                out.append((c, w, *seen, used))
                n = max(k for k in range(turns + 1) if k == 0 or (
                    i - k >= has_sys and sum(tok[i - k:i]) <= tokens
                    and sys + sum(tok[i - k:i]) + t <= budget))
                w, used, seen = w + 1, sys + sum(tok[i - n:i]), [n + has_sys, n + has_sys]
            used += t
            seen[1] += 1
        out.append((c, w, *seen, used))
    return sorted(out, key=str)


def shapes(windows):
    return sorted(((r["conv_id"], r["window"], r["n_repeated"], r["n_turns"], r["tokens"])
                   for r in windows.collect()), key=str)


@pytest.mark.parametrize("chunk,group", [(0, 1), (2, 2)])
def test_windows_across_chunks_and_groups(spark, monkeypatch, chunk, group):
    monkeypatch.setattr(chat, "CHUNK_BITS", chunk)
    monkeypatch.setattr(chat, "GROUP_BITS", group)
    rows = awkward_turns() + [(5000, t, "user", "z" * (t * 7 % 50)) for t in range(150)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for budget, turns, tokens in [(512, 2, 128), (60, 3, 40), (40, 0, 0)]:
        got = shapes(chat.format_windows(df, budget, turns, tokens))
        assert got == brute_windows(rows, budget, turns, tokens)


def test_conversation_of_many_turns(spark):
    """A row never holds the conversation: one copy a window would be 80 GB."""
    rows = [(None, t, "assistant" if t % 2 else "user", "y" * 400) for t in range(30_000)]
    df = spark.range(30_000).select(
        F.lit(None).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"),
        F.lit("y" * 400).alias("text"))
    assert shapes(chat.format_windows(df)) == brute_windows(rows, 512, 2, 128)


def test_windows_keep_system_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [
        (1, t, "user" if t % 2 else "assistant", f"turn {t} " + "y" * 400) for t in range(1, 9)]
    w = chat.format_windows(spark.createDataFrame(rows, SCHEMA), 300, 1, 150).orderBy("window")
    out = w.collect()
    assert len(out) > 2 and all(r["text"].startswith("<|im_start|>system\nbe kind") for r in out)
    assert [r["n_repeated"] for r in out] == [0] + [2] * (len(out) - 1)
    assert sum(len(r["loss_spans"]) for r in out) == 4


def test_chat_of_nothing(spark):
    none = chat.format_windows(spark.createDataFrame([], SCHEMA))
    assert chat.conversation_digests(none).count() == 0
