"""What a job does once must not be done once more for each reader, batch or band."""

from recspark.operators import evaluate, lsh
from recspark.plans import queries
from conftest import SF_SMALL


def test_bands_are_bounded_and_keep_the_recall():
    for n in (10_000, 100_000, 10_000_000):
        bits, bands = lsh.shape(0.3, n)
        meet = 0.5969 ** bits                      # 1 - acos(0.3) / pi
        assert bands <= lsh.MOST_BANDS and 1 - (1 - meet) ** bands >= 0.969
    assert lsh.shape(0.3, 2000) == (3, 15)


def test_rows_carry_only_the_codes_of_earlier_bands(spark):
    rows = [(i, [float(i % 5 + 1), float(i % 3), 1.0]) for i in range(300)]
    df = spark.createDataFrame(rows, "mid int, features array<double>")
    got = lsh.similar_items_approx(df, floor=0.99, k=None, block_size=16).collect()
    assert len(got) == len({(r.mid, r.sim_mid) for r in got}) > 0


def test_a_grid_takes_the_training_sums_once(spark, monkeypatch):
    calls, inner = [], evaluate.damped_sums
    monkeypatch.setattr(evaluate, "damped_sums", lambda t: calls.append(1) or inner(t))
    df = spark.createDataFrame([(i % 7, i % 5, float(i % 9)) for i in range(200)],
                               "uid int, mid int, score double")
    got = evaluate.best_damping(df, df, df, [(0.0, 0.0), (5.0, 5.0)]).first()
    assert len(calls) == 1 and abs(got["valid_rmse"] - got["rmse"]) < 1e-12


def test_a_micro_batch_takes_a_million_events():
    assert queries.EVENTS_PER_FILE * queries.FILES_PER_BATCH >= 1_000_000


def test_similarities_are_computed_once_for_both_readers(spark):
    for name in ("stream_recs_batch", "stream_recs_ordered"):
        plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
        assert "FlatMapGroupsIn" not in plan
