import tempfile

from pyspark.sql import functions as F

from recspark.operators import rerank, topk
from recspark.plans import views
from recspark.operators.similarity import similar_items
from recspark.streaming import StreamRecommender, file_rating_events

SF = "/root/testdata/sf0.001"


def _flat(df):
    return sorted((r.uid, r.mid, r.score) for r in df.collect())


def test_stream_equals_batch_and_restarts(spark):
    root = tempfile.mkdtemp(prefix="recspark-stream-")
    ev = views.stream_events(spark, SF)
    sims = similar_items(views.embeddings(spark, SF), floor=0.1, k=20, digits=6)
    sims.write.parquet(f"{root}/sims")
    seen = views.ratings(spark, SF).select("uid", "mid")
    seen.write.parquet(f"{root}/seen")
    half = ev.agg(F.max("event_id")).first()[0] // 2
    # first run: three files of the first half
    ev.where(F.col("event_id") <= half).repartitionByRange(3, "event_id") \
        .write.parquet(f"{root}/events/part=0")
    rec = StreamRecommender(lambda: spark.read.parquet(f"{root}/sims"),
                            lambda: spark.read.parquet(f"{root}/seen"),
                            f"{root}/recs", gate=0.2, digits=6)

    def run():
        q = rec.start(file_rating_events(spark, f"{root}/events"),
                      checkpoint=f"{root}/ckpt", trigger={"availableNow": True})
        q.awaitTermination()
        return q

    run()
    rec.compact(spark)  # later reads: snapshot + newer log partitions
    first = ev.where(F.col("event_id") <= half)
    want1 = rerank.recommend_from_events(first, spark.read.parquet(f"{root}/sims"),
                                         spark.read.parquet(f"{root}/seen"), gate=0.2, digits=6)
    got1 = topk.explode_recs(rec.read_recs(spark), "uid", item_alias="mid", rank_col=None)
    assert _flat(got1) == _flat(want1)
    # restart from the checkpoint with the second half: state carries over
    ev.where(F.col("event_id") > half).repartitionByRange(2, "event_id") \
        .write.parquet(f"{root}/events/part=1")
    q = run()
    assert q.lastProgress is not None
    want = rerank.recommend_from_events(ev, spark.read.parquet(f"{root}/sims"),
                                        spark.read.parquet(f"{root}/seen"), gate=0.2, digits=6)
    got = topk.explode_recs(rec.read_recs(spark), "uid", item_alias="mid", rank_col=None)
    assert len(_flat(want)) > 0
    assert _flat(got) == _flat(want)


def _scans(node):
    """The file scans of a plan that has run."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _scans(node.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from _scans(node.plan())
    elif name == "FileSourceScanExec":
        yield node
    else:
        for i in range(node.children().size()):
            yield from _scans(node.children().apply(i))


def _read(df):
    """(rows, bytes of the files read) of a table of lookups."""
    query = df._jdf.queryExecution()
    rows = query.executedPlan().executeCollectPublic()
    sizes = [s.metrics().get("filesSize").get().value() for s in _scans(query.executedPlan())]
    return len(rows), sum(sizes)


def test_lookup_reads_the_folders_of_its_keys(spark):
    from recspark import sources
    root = tempfile.mkdtemp(prefix="recspark-lookup-")
    table = spark.range(5000).select(F.col("id").cast("int").alias("uid"),
                                     (F.col("id") * 10).alias("v"))
    # a third of the rows on one key, and some without one
    table = table.union(spark.range(2500).select(F.lit(7), F.col("id")))
    table = table.union(spark.range(3).select(F.lit(None).cast("int"), F.col("id")))
    sources.write_clustered(table, f"{root}/t", "uid", bucket_rows=500)
    stored = sources.read_clustered(spark, f"{root}/t")
    assert stored.select(sources.BUCKET_COL).distinct().count() == 16
    keys = spark.createDataFrame([(3,), (7,), (7,), (4999,), (None,)], "uid int")
    got = sources.rows_of_keys(stored, "uid", keys)
    assert got.columns == ["uid", "v"]
    want = table.where("uid in (3, 7, 4999)")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plain = sources.rows_of_keys(table, "uid", keys)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, want.collect()))
    # a smaller table in its place has fewer buckets; an empty one has none
    sources.write_clustered(table.where("uid < 600 and uid <> 7"), f"{root}/t", "uid",
                            bucket_rows=500)
    stored = sources.read_clustered(spark, f"{root}/t")
    assert stored.select(sources.BUCKET_COL).distinct().count() == 2
    assert [r.uid for r in sources.rows_of_keys(stored, "uid", keys).collect()] == [3]
    sources.write_clustered(table.where("uid < 0"), f"{root}/t", "uid")
    stored = sources.read_clustered(spark, f"{root}/t")
    assert stored.columns == ["uid", "v"]
    assert sources.rows_of_keys(stored, "uid", keys).count() == 0


def test_bytes_of_a_lookup_follow_its_keys(spark):
    from recspark import sources
    root = tempfile.mkdtemp(prefix="recspark-lookup-")
    table = spark.range(2_000_000).select((F.col("id") % 400_000).cast("int").alias("uid"),
                                          F.xxhash64("id").alias("v"))
    sources.write_clustered(table, f"{root}/t", "uid", bucket_rows=4_000)
    stored = sources.read_clustered(spark, f"{root}/t")
    assert stored.select(sources.BUCKET_COL).distinct().count() == 500
    whole = _read(stored)[1]
    seen = {}
    for n in (20, 200, 20_000):
        keys = spark.range(n).select((F.col("id") * 19).cast("int").alias("uid"))
        rows, seen[n] = _read(sources.rows_of_keys(stored, "uid", keys))
        assert rows == 5 * n
    # 20 keys are in 20 of 500 buckets at most, 200 in about 165, 20,000 in all
    assert 0 < seen[20] < whole * 0.05
    assert whole * 0.2 < seen[200] < whole * 0.42
    assert seen[20_000] <= whole
    # a key with a third of the rows does not make one task's file
    hot = table.select(F.when(F.col("uid") % 3 == 0, 0).otherwise(F.col("uid")).alias("uid"), "v")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sources.write_clustered(hot, f"{root}/hot", "uid", bucket_rows=100_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = (sources.read_clustered(spark, f"{root}/hot").where("uid = 0")
             .groupBy(F.input_file_name()).count().collect())
    assert len(files) > 1


def test_cut_before_the_state_keeps_the_newest():
    import pandas as pd
    from recspark.streaming.recommender import cut_recent
    f = pd.DataFrame({"uid": [1] * 50 + [2, 2], "ts": [*range(50), 5, 5],
                      "event_id": range(52)})
    out = pd.concat(cut_recent(3)([f]))
    assert sorted(out["event_id"]) == [47, 48, 49, 50, 51]


def test_hot_user_null_fields_and_processing_time(spark):
    """A third of the events on one user, rows with NULL fields, a timed trigger."""
    import time
    from recspark.streaming.recommender import valid_events
    root = tempfile.mkdtemp(prefix="recspark-hot-")
    rows = [(i, 1 if i % 3 == 0 else i % 20, i % 15, float(i % 5 + 1), 1000 + i // 4)
            for i in range(600)]
    schema = "event_id long, uid int, mid int, score double, ts int"
    broken = [(900, None, 3, 1.0, 5000), (901, 4, None, 1.0, 5000), (902, 4, 3, None, 5000),
              (903, 4, 3, 1.0, None), (None, 4, 3, 1.0, 5000)]
    ev = spark.createDataFrame(rows, schema)
    ev.union(spark.createDataFrame(broken, schema)).repartition(3).write.parquet(f"{root}/events")
    sims = spark.createDataFrame([(a, b, 0.9 - 0.01 * abs(a - b)) for a in range(15)
                                  for b in range(40) if a != b], "mid int, sim_mid int, score double")
    seen = spark.createDataFrame([(u, m) for u in range(20) for m in range(3)], "uid int, mid int")
    rec = StreamRecommender(sims, seen, f"{root}/recs", gate=0.2, digits=6)
    stream = file_rating_events(spark, f"{root}/events", schema, 1)
    q = rec.start(stream, checkpoint=f"{root}/ckpt", trigger={"processingTime": "1 second"})
    try:
        for _ in range(120):
            time.sleep(1)
            assert q.exception() is None
            done = sum(p["numInputRows"] for p in q.recentProgress)
            if done >= 605:
                break
        assert done == 605
    finally:
        q.stop()
    want = rerank.recommend_from_events(ev, sims, seen, gate=0.2, digits=6)
    got = topk.explode_recs(rec.read_recs(spark), "uid", item_alias="mid", rank_col=None)
    assert _flat(got) == _flat(want) and len(_flat(want)) > 0
    _, bad = valid_events(spark.read.schema(schema).parquet(f"{root}/events"))
    assert bad.count() == 5 and {r.reason for r in bad.collect()} == {"missing field"}


def test_text_messages_and_quarantine_stream(spark):
    from recspark.streaming.recommender import text_rating_events
    root = tempfile.mkdtemp(prefix="recspark-msg-")
    with open(f"{root}/m1.txt", "w") as f:
        f.write("1|10|4.5|100|0\n2|11|3.0|101|1\nbad line\n3|x|1.0|102|2\n4|12|2.0|103\n")
    good, bad = text_rating_events(spark, root + "/")
    q1 = (good.writeStream.format("parquet").option("path", f"{root}/out/good")
          .option("checkpointLocation", f"{root}/ck/good").trigger(availableNow=True).start())
    q2 = StreamRecommender.start_quarantine(bad, f"{root}/out/bad", f"{root}/ck/bad",
                                            trigger={"availableNow": True})
    q1.awaitTermination()
    q2.awaitTermination()
    g = sorted(tuple(r) for r in spark.read.parquet(f"{root}/out/good")
               .select("event_id", "uid", "mid", "score", "ts").collect())
    assert g == [(0, 1, 10, 4.5, 100), (1, 2, 11, 3.0, 101)]
    b = sorted((r.line, r.reason) for r in spark.read.parquet(f"{root}/out/bad").collect())
    assert b == [("3|x|1.0|102|2", "bad number"), ("4|12|2.0|103", "too few fields"),
                 ("bad line", "too few fields")]
