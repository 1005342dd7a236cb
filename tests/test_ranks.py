"""Global ranks, the counting range join, chunked lists, bitmaps and excluded items."""

import random

import numpy as np
from pyspark.sql import functions as F

from recspark import sources
from recspark.operators import factors, ranks, stats


def _months(n=900):
    r = random.Random(2)
    # A third of the rows in one month, a null month, equal counts, negative and large ids.
    return [(i * 7919 - 10 ** 6, 202001 if i % 3 == 0 else r.choice([202002, 202003, None]),
             r.randrange(4)) for i in range(n)]


def test_ranks_of_all_rows_and_of_groups(spark):
    rows = _months()
    df = spark.createDataFrame(rows, "mid int, month int, n int").repartition(6)
    got = ranks.rank_rows(df, [F.desc("n"), "mid"], "pos").collect()
    want = {m: i for i, (m, _, _) in enumerate(sorted(rows, key=lambda x: (-x[2], x[0])))}
    assert {r.mid: r.pos for r in got} == want
    got = ranks.rank_rows(df, [F.desc("n"), "mid"], "pos", ["month"]).collect()
    want = {}
    for month in {m for _, m, _ in rows}:
        some = sorted((x for x in rows if x[1] == month), key=lambda x: (-x[2], x[0]))
        want.update({x[0]: i for i, x in enumerate(some)})
    assert {r.mid: r.pos for r in got} == want
    assert ranks.rank_rows(df.limit(0), ["mid"]).collect() == []


def test_ranks_have_no_window_over_a_group(spark):
    df = spark.createDataFrame(_months(60), "mid int, month int, n int")
    plan = ranks.rank_rows(df, [F.desc("n"), "mid"], "pos", ["month"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and plan.count("Window [") <= 1


def test_marks_before_each_value(spark):
    r = random.Random(3)
    rows = [(r.randrange(20) / 2, k, k == 0) for k in (0, 1) for _ in range(200)]
    df = spark.createDataFrame(rows, "v double, kind int, mark boolean").repartition(5)
    got = ranks.count_before(df, [F.desc("v"), "kind"], "mark", "n").where("kind = 1").collect()
    assert len(got) == 200
    assert all(x.n == sum(1 for v, k, _ in rows if k == 0 and v >= x.v) for x in got)


def test_summary_by_bitmaps(spark):
    r = random.Random(4)
    ids = [None, 0, 1, -1, 32768, 32769, 2 ** 31 - 1, -2 ** 31, *range(100, 160)]
    rows = [(r.choice(ids), r.choice(ids), r.choice("ab")) for _ in range(400)]
    df = spark.createDataFrame(rows, "uid int, mid int, part string").repartition(4)
    got = stats.dataset_summary(df).first()
    assert tuple(got) == (400, len({u for u, _, _ in rows} - {None}),
                          len({m for _, m, _ in rows} - {None}))
    parts = {x.part: tuple(x)[1:] for x in stats.dataset_summary(df, ["part"]).collect()}
    for p in "ab":
        some = [x for x in rows if x[2] == p]
        assert parts[p] == (len(some), len({u for u, _, _ in some} - {None}),
                            len({m for _, m, _ in some} - {None}))
    assert tuple(stats.dataset_summary(df.limit(0)).first()) == (0, 0, 0)
    assert "Expand" not in stats.dataset_summary(df)._jdf.queryExecution().executedPlan().toString()


def test_lists_in_chunks(spark):
    """A user with a third of the events fills many rows; the first K are read back."""
    rows = [(i, 1 if i % 3 == 0 else 2 + i % 5, i % 50, 1.0 + i % 9 / 2, 1000 - i % 40)
            for i in range(300)]
    ev = spark.createDataFrame(rows, "event_id long, uid int, mid int, score double, ts int")
    lists = sources.encode_recent_lists(ev, chunk=7)
    assert lists.agg(F.max(F.size("items"))).first()[0] == 7
    assert lists.where("key = 'uid:1'").count() == 15
    for k in (3, 7, 20, None):
        good, bad = sources.parse_recent_lists(lists, k=k, chunk_col="chunk", chunk=7)
        got = {}
        for r in good.orderBy("uid", "rn").collect():
            got.setdefault(r.uid, []).append((r.mid, r.score))
        for u in {r[1] for r in rows}:
            newest = sorted((r for r in rows if r[1] == u), key=lambda r: (-r[4], -r[0]))
            assert got[u] == [(r[2], r[3]) for r in newest][:k]
        assert bad.count() == 0


def test_excluded_pairs_are_left_out_exactly(spark):
    rng = np.random.default_rng(7)
    u, v = rng.normal(size=(25, 4)), rng.normal(size=(120, 4)) * rng.exponential(size=(120, 1))
    left, right = (spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)],
                                         "id int, vector array<double>") for m in (u, v))
    s = u @ v.T
    gone = {(i, int(j)) for i in range(25) for j in np.argsort(-s[i])[:(i * 7) % 60]}
    gone |= {(3, j) for j in range(120)} | {(4, int(j)) for j in rng.integers(0, 120, 50)}
    seen = spark.createDataFrame(sorted(gone) * 2, "id int, other int")
    got = factors.best_matches(left, right, 5, pack=16, exclude=seen).collect()
    want = []
    for i in range(25):
        order = [int(j) for j in np.argsort(-s[i], kind="stable") if (i, int(j)) not in gone]
        want += [(i, r + 1, j) for r, j in enumerate(order[:5])]
    assert sorted((x.id, x.rk, x.other) for x in got) == want
