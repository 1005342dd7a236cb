"""The job entry points run end to end at sf0.001 and write the original tables."""

import tempfile

from pyspark.sql import functions as F

from recspark import jobs
from recspark.plans import views
from recspark.schema import RECS

SF = "/root/testdata/sf0.001"


def _s(c):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def test_jobs_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="recspark-jobs-")
    m = views.movies(spark, SF)
    m.select(F.concat_ws("^", _s("mid"), _s("name"), *[F.lit("")] * 5, _s("genres"),
                         F.lit(""), F.lit("")).alias("v")).write.text(f"{root}/in/movies")
    views.ratings(spark, SF).select(F.concat_ws(",", _s("uid"), _s("mid"), _s("score"),
                                                _s("ts"))).write.text(f"{root}/in/ratings")
    views.tags(spark, SF).select(F.concat_ws(",", _s("uid"), _s("mid"), _s("tag"),
                                             _s("ts"))).write.text(f"{root}/in/tags")
    out = f"{root}/out"
    loaded = jobs.load_data(spark, f"{root}/in/movies", f"{root}/in/ratings",
                            f"{root}/in/tags", out)
    assert loaded["Movie"].count() == m.count()
    assert spark.read.json(f"{out}/MovieWithTags").count() == m.count()
    ratings = spark.read.parquet(f"{out}/Rating")
    movies = spark.read.parquet(f"{out}/Movie")

    st = jobs.statistics(ratings, movies, out, genres=["Large", "Red", "Foreign"])
    g = spark.read.parquet(f"{out}/GenresTopMovies")
    assert g.schema["recs"].dataType == RECS
    assert {r.genres for r in g.collect()} == {"Large", "Red"}
    assert all(len(r.recs) <= 10 for r in g.collect())
    assert set(st) == {"RateMoreMovies", "RateMoreRecentlyMovies", "AverageMovies",
                       "GenresTopMovies"}

    jobs.offline(ratings, out, rank=8, max_iter=2)
    ur = spark.read.parquet(f"{out}/UserRecs")
    assert ur.schema["recs"].dataType == RECS and ur.count() > 0

    jobs.content(movies, out, k=20)
    cr = spark.read.parquet(f"{out}/ContentMovieRecs").collect()
    assert cr and all(x.score > 0.6 for r in cr for x in r.recs)

    best = jobs.evaluate_als(ratings, sweep=False,
                             grid=dict(ranks=[4], iterations=[2], lambdas=[0.1]))["best"]
    assert best.count() == 1

    ev = views.stream_events(spark, SF)
    ev.repartition(2).write.parquet(f"{root}/events")
    from recspark.streaming import file_rating_events
    q, rec = jobs.streaming(file_rating_events(spark, f"{root}/events"),
                            f"{out}/MovieRecs", f"{out}/Rating", out, f"{root}/ckpt",
                            trigger={"availableNow": True})
    q.awaitTermination()
    assert rec.read_recs(spark).count() == ev.select("uid").distinct().count()
