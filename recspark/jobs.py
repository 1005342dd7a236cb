"""The original batch and streaming jobs, composed from the operators.

Each job reads DataFrames (or text paths), writes its output tables with
``sinks.write_table`` under ``out`` (one folder per table, format and options
passed through) and returns the written DataFrames.  Nested
``recs ARRAY<STRUCT<mid, score>>`` columns keep the original table shapes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark import schema as S
from recspark.operators import (content as content_ops, evaluate, factors, splits,
                                stats, tags as tag_ops, topk)
from recspark.session import saved
from recspark.sources import sinks, text


def _write(df: DataFrame, out: str, name: str, fmt: str, **options) -> DataFrame:
    sinks.write_table(df, f"{out.rstrip('/')}/{name}", fmt, **options)
    return df


def load_data(spark: SparkSession, movie_path: str, rating_path: str, tag_path: str,
              out: str, fmt: str = "parquet", docs_fmt: str = "json") -> dict[str, DataFrame]:
    """S1-S3 -> K1/K4 (Movie, Rating, Tag) -> A4 + J2 -> K2 (MovieWithTags).

    Unparseable lines go to ``<table>_bad`` instead of failing the job.
    """
    result = {}
    for name, reader, path in ((S.TABLE_MOVIE, text.read_movies_text, movie_path),
                               (S.TABLE_RATING, text.read_ratings_csv, rating_path),
                               (S.TABLE_TAG, text.read_tags_csv, tag_path)):
        good, bad = reader(spark, path)
        if name == S.TABLE_RATING:          # looked up by user while streaming
            sinks.write_clustered(good, f"{out.rstrip('/')}/{name}", "uid", fmt)
            result[name] = good
        else:
            result[name] = _write(good, out, name, fmt)
        _write(bad, out, f"{name}_bad", fmt)
    movies = spark.read.format(fmt).load(f"{out.rstrip('/')}/{S.TABLE_MOVIE}")
    tags = spark.read.format(fmt).load(f"{out.rstrip('/')}/{S.TABLE_TAG}")
    with_tags = tag_ops.items_with_tags(movies, tags)
    sinks.write_keyed_docs(with_tags, "mid", f"{out.rstrip('/')}/{S.TABLE_MOVIE_WITH_TAGS}",
                           [F.asc("name"), F.asc("genres"), F.asc("tags")], docs_fmt)
    result[S.TABLE_MOVIE_WITH_TAGS] = with_tags
    return result


def statistics(ratings: DataFrame, movies: DataFrame, out: str, genres=None,
               zone: str = "UTC", fmt: str = "parquet") -> dict[str, DataFrame]:
    """A1/O1, A2/X3/O2, A3, J1 + J3 + W1 nested per genre."""
    avg = _write(stats.item_average(ratings), out, S.TABLE_AVERAGE, fmt)
    avg = ratings.sparkSession.read.format(fmt).load(f"{out.rstrip('/')}/{S.TABLE_AVERAGE}")
    top = stats.genre_top_n(movies, avg, genres, k=S.GENRE_TOP_K)
    nested = topk.nest_recs(top.withColumnRenamed("genre", "genres"), "genres",
                            score_col="avg")
    return {
        S.TABLE_RATE_MORE: _write(stats.item_popularity(ratings, ordered=True), out,
                                  S.TABLE_RATE_MORE, fmt),
        S.TABLE_RATE_MORE_RECENTLY: _write(
            stats.item_popularity_by_month(ratings, zone=zone, ordered=True), out,
            S.TABLE_RATE_MORE_RECENTLY, fmt),
        S.TABLE_AVERAGE: avg,
        S.TABLE_GENRES_TOP: _write(nested, out, S.TABLE_GENRES_TOP, fmt),
    }


def offline(ratings: DataFrame, out: str, rank: int = S.OFFLINE_ALS["rank"],
            max_iter: int = S.OFFLINE_ALS["max_iter"],
            reg_param: float = S.OFFLINE_ALS["reg_param"], seed: int = 42,
            fmt: str = "parquet") -> dict[str, DataFrame]:
    """V6 -> UserRecs (J4, F1, W2) and MovieRecs (V8, V3, F3, W3), nested."""
    model = factors.fit_als(ratings, rank, max_iter, reg_param, seed)
    user = topk.nest_recs(factors.user_recs(model, S.USER_RECS_K), "uid")
    item = saved(topk.nest_recs(factors.item_similar(model, S.ITEM_SIM_FLOOR, S.ITEM_SIMS_K),
                                "mid", item_col="sim_mid"), "movie-recs")
    # MovieRecs is looked up by item while streaming.
    sinks.write_clustered(item, f"{out.rstrip('/')}/{S.TABLE_MOVIE_RECS}", "mid", fmt)
    return {S.TABLE_USER_RECS: _write(user, out, S.TABLE_USER_RECS, fmt),
            S.TABLE_MOVIE_RECS: item}


def content(movies: DataFrame, out: str, k: int, hashed: bool = True,
            fmt: str = "parquet") -> dict[str, DataFrame]:
    """P4 + V2 + V4 + V5 + V3 -> ContentMovieRecs, the best k above the floor.
    The uncut list (W4) is ``content.similar_groups`` with ``group_members``."""
    sims = content_ops.content_similar_items(movies, k, S.ITEM_SIM_FLOOR, hashed=hashed)
    nested = topk.nest_recs(sims, "mid", item_col="sim_mid")
    return {S.TABLE_CONTENT_RECS: _write(nested, out, S.TABLE_CONTENT_RECS, fmt)}


def evaluate_als(ratings: DataFrame, seed: int = 42, sweep: bool = True,
                 grid: dict | None = None) -> dict[str, DataFrame]:
    """U1 split 8:1:1 -> V12 sweeps, V13 grid + refit, V14 test RMSE."""
    r = splits.hash_split(ratings, ["uid", "mid", "ts"], [0.8, 0.1, 0.1],
                          ["train", "validation", "test"])
    train, valid, test = (r.where(F.col("split") == p).drop("split")
                          for p in ("train", "validation", "test"))
    out = {}
    if sweep:
        out["sweep"] = evaluate.param_sweep(train, valid, seed=seed)
    out["best"] = evaluate.train_validate_test(train, valid, test, seed=seed, **(grid or {}))
    return out


def streaming(events: DataFrame, movie_recs: str, ratings: str, out: str,
              checkpoint: str, trigger: dict | None = None, fmt: str = "parquet"):
    """Start the re-ranking stream; MovieRecs and Rating are re-read
    from their tables every batch.  Returns (query, recommender)."""
    from recspark.streaming import StreamRecommender
    spark = events.sparkSession

    def sims():
        t = sinks.read_clustered(spark, movie_recs, fmt)
        extra = [c for c in (sinks.BUCKET_COL,) if c in t.columns]
        return t.select("mid", *extra, F.explode("recs").alias("_r")).select(
            "mid", *extra, F.col("_r.mid").alias("sim_mid"), F.col("_r.score").alias("score"))

    def seen():
        t = sinks.read_clustered(spark, ratings, fmt)
        return t.select("uid", "mid", *(c for c in (sinks.BUCKET_COL,) if c in t.columns))

    rec = StreamRecommender(sims, seen, f"{out.rstrip('/')}/{S.TABLE_STREAM_RECS}")
    return rec.start(events, checkpoint=checkpoint, trigger=trigger), rec
