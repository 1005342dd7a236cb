"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Results are flat rows (no nested arrays) so they hash the same as the
oracle's; the nested recommendation form is built by ``topk.nest_recs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark import sources
from recspark.session import saved, scratch_path

from recspark.operators import (content, evaluate, factors, lsh, ranks, rerank, similarity, splits,
                                stats, topk)
from recspark.operators import tags as tagops
from recspark.plans import views
from recspark.plans.oracle import DAMPINGS, GENRE_TEST_LIST
from recspark.schema import (DEFAULT_GENRES, INTERACTIVE_ALS, INTERACTIVE_K, MOVIE_FIELDS,
                             OFFLINE_ALS)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def reg(fn):
        QUERIES[name] = fn
        return fn
    return reg


# --- statistics ---------------------------------------------------------------

@query("item_popularity")
def item_popularity(spark, d):
    """A1, O1."""
    return stats.item_popularity(views.ratings(spark, d))


@query("item_popularity_by_month")
def item_popularity_by_month(spark, d):
    """A2, P2, X3, O2."""
    return stats.item_popularity_by_month(views.ratings(spark, d))


@query("item_average")
def item_average(spark, d):
    """A3."""
    return stats.item_average(views.ratings(spark, d))


@query("genre_top_n")
def genre_top_n(spark, d):
    """J1, J3, F5, W1 - substring genre matching as in the original."""
    r = views.ratings(spark, d)
    return stats.genre_top_n(views.movies(spark, d), stats.item_average(r),
                             GENRE_TEST_LIST, k=10)


@query("genre_top_n_token")
def genre_top_n_token(spark, d):
    """J1, J3 (as equi-join on tokens), W1."""
    r = views.ratings(spark, d)
    return stats.genre_top_n(views.movies(spark, d), stats.item_average(r),
                             GENRE_TEST_LIST, k=10, match="token")


@query("genre_top_n_defaults")
def genre_top_n_defaults(spark, d):
    """J3, F5, W1 over the default genre list."""
    return stats.genre_top_n(views.movies_with_default_genres(spark, d),
                             stats.item_average(views.ratings(spark, d)), DEFAULT_GENRES)


@query("item_popularity_ordered")
def item_popularity_ordered(spark, d):
    """A1, O1: the position of every item in the order count desc, mid."""
    pop = stats.item_popularity(views.ratings(spark, d))
    ranked = ranks.rank_rows(pop, [F.desc("count"), "mid"], "_pos")
    return ranked.select((F.col("_pos") + 1).alias("pos"), "mid", "count")


@query("item_popularity_by_month_ordered")
def item_popularity_by_month_ordered(spark, d):
    """A2, O2: the position of every item in its month, count desc, mid."""
    pop = stats.item_popularity_by_month(views.ratings(spark, d))
    ranked = ranks.rank_rows(pop, [F.desc("count"), "mid"], "_pos", ["yearmonth"])
    return ranked.withColumn("pos", F.col("_pos") + 1).drop("_pos")


@query("items_with_tags")
def items_with_tags(spark, d):
    """A4, J2, P3."""
    return tagops.items_with_tags(views.movies(spark, d), views.tags(spark, d))


@query("dataset_summary")
def dataset_summary(spark, d):
    """A6, A7."""
    return stats.dataset_summary(views.ratings(spark, d))


# --- item similarity ----------------------------------------------------------

def _vector_sims(spark, d):
    # Embeddings: the highest cosine is about 0.5, so the floor is 0.1.
    return similarity.similar_items(views.embeddings(spark, d), floor=0.1, k=20, digits=6)


@query("vector_similar_items_approx")
def vector_similar_items_approx(spark, d):
    """V3, approximate: cosine above 0.3 by banded sign projections, best 20; about 3%
    of the pairs at the floor may be missing, so rows only are checked."""
    return lsh.similar_items_approx(views.embeddings(spark, d), floor=0.3, k=20, digits=6)


@query("vector_similar_items")
def vector_similar_items(spark, d):
    """V1, V3, F2, F3, W3 - blocked exact all-pairs cosine."""
    return _vector_sims(spark, d)


@query("similarity_long_form")
def similarity_long_form(spark, d):
    """A5 nest to (mid, recs) then S10 explode back to (mid, sim_mid, score, rk)."""
    nested = topk.nest_recs(_vector_sims(spark, d), "mid", item_col="sim_mid")
    long = topk.explode_recs(nested, "mid")
    # A repeated (mid, sim_mid) keeps one entry, the best-ranked one.
    long = topk.dedupe_last_wins(long, ["mid", "sim_mid"], [F.asc("rk")])
    return long.select("mid", "sim_mid", "score", "rk")


@query("content_similar_items")
def content_similar_items(spark, d):
    """P4, exact TF-IDF, V3 over distinct term lists, expansion, W3."""
    return content.content_similar_items(views.movies(spark, d), 20, floor=0.6, digits=6)


@query("content_similar_items_all")
def content_similar_items_all(spark, d):
    """W4, factored: every pair of groups above the 0.6 floor, uncut."""
    return content.similar_groups(views.movies(spark, d), floor=0.6, digits=6)


@query("content_group_members")
def content_group_members(spark, d):
    """W4, factored: the group of every item."""
    return content.group_members(views.movies(spark, d))


@query("content_similar_items_hashed")
def content_similar_items_hashed(spark, d):
    """V2, V4, V5 (Spark ML HashingTF(50) / IDF), V3, W3."""
    return content.content_similar_items(views.movies(spark, d), 20, floor=0.6, digits=6,
                                         hashed=True)


# --- splits and evaluation ------------------------------------------------------

@query("hash_split")
def hash_split(spark, d):
    """Repeatable 8:1:1 train/validation/test split by md5 of event_id."""
    ev = views.stream_events(spark, d).select("event_id", "uid", "mid")
    h, _ = splits.hash_unit(["event_id"])
    out = splits.hash_split(ev, ["event_id"], [0.8, 0.1, 0.1],
                            ["train", "validation", "test"])
    return out.withColumn("bucket", (h % 10).cast("bigint"))


@query("kfold_split")
def kfold_split(spark, d):
    """Five contiguous folds by position (event_id is the position)."""
    ev = views.stream_events(spark, d).select("event_id", "uid", "mid")
    return splits.kfold_assign(ev, "event_id", k=5)


@query("leave_n_out_split")
def leave_n_out_split(spark, d):
    """Ratings 1..10 of each user (by position) are test, the rest base."""
    ev = views.stream_events(spark, d).select("event_id", "uid", "mid")
    return splits.leave_n_out(ev, "uid", "event_id", 1, 10)


@query("leave_n_out_capped")
def leave_n_out_capped(spark, d):
    """W7 with the global cap: at most 1,000 test rows, first by position."""
    ev = views.stream_events(spark, d).select("event_id", "uid", "mid")
    return splits.leave_n_out(ev, "uid", "event_id", 11, 20, max_test=1000)


@query("split_summary")
def split_summary(spark, d):
    """A7 + U1: ratings, users and items per part of an 8:1:1 hash split."""
    r = splits.hash_split(views.ratings(spark, d), ["uid", "mid", "ts"], [0.8, 0.1, 0.1],
                          ["train", "validation", "test"])
    return stats.dataset_summary(r, by=["split"])


@query("kfold_fold_sets")
def kfold_fold_sets(spark, d):
    """Base and test of fold 2; a row's place in the order of its user."""
    ev = views.stream_events(spark, d).select("event_id", "uid", "mid")
    base, test = splits.kfold_sets(splits.kfold_assign(ev, "event_id", k=5), 2)
    both = base.withColumn("part", F.lit("base")).unionByName(
        test.withColumn("part", F.lit("test")))
    return topk.top_k_per_key(both, ["part", "uid"], [F.asc("mid"), F.asc("event_id")], None, "pos")


@query("last_rating_wins")
def last_rating_wins(spark, d):
    """A11 on rows with duplicates: each user's newest rating of an item."""
    return topk.dedupe_last_wins(views.stream_events(spark, d), ["uid", "mid"],
                                 rerank.event_order())


@query("rmse_item_mean")
def rmse_item_mean(spark, d):
    """Item-mean predictor scored on all ratings, one scan."""
    every = F.lit(True)
    return evaluate.item_mean_rmse(views.ratings(spark, d), every, every, digits=6)


def _two_way(spark, d):
    return splits.hash_split(views.ratings(spark, d), ["uid", "mid", "ts"], [0.8, 0.2],
                             ["train", "test"])


@query("rmse_item_mean_split")
def rmse_item_mean_split(spark, d):
    """Item means from an 8:2 hash split; unseen test items count."""
    return evaluate.item_mean_rmse(_two_way(spark, d), F.col("split") == "train",
                                   F.col("split") == "test", digits=6)


@query("rmse_item_mean_price")
def rmse_item_mean_price(spark, d):
    """A8 on large values: each item's mean price as prediction of its line prices."""
    li = views.table(spark, d, "lineitem").select(
        F.col("l_partkey").cast("int").alias("mid"),
        F.col("l_extendedprice").cast("double").alias("score"))
    every = F.lit(True)
    return evaluate.item_mean_rmse(li, every, every, digits=3)


@query("rmse_joined_predictions")
def rmse_joined_predictions(spark, d):
    """J6 as a join on (uid, mid), where repeated pairs multiply, then A8."""
    r = views.ratings(spark, d)
    predicted = evaluate.item_mean_predictions(r, r)
    return evaluate.rmse_report(evaluate.join_predictions(predicted, r), digits=6)


def _parts(split, names):
    """The parts of a split; it is written once, as a fit or grid reads it many times."""
    r = saved(split.select("uid", "mid", "score", "split"), "parts")
    return [r.where(F.col("split") == p) for p in names]


def _three_parts(spark, d):
    names = ["train", "validation", "test"]
    return _parts(splits.hash_split(views.ratings(spark, d), ["uid", "mid", "ts"],
                                    [0.8, 0.1, 0.1], names), names)


@query("damped_sweep")
def damped_sweep(spark, d):
    """One validation RMSE per setting of the closed-form predictor."""
    train, valid, _ = _three_parts(spark, d)
    out = evaluate.damped_scores(train, valid, DAMPINGS)
    return out.withColumn("rmse", evaluate.round_half_up("rmse", 6))


@query("damped_grid_best")
def damped_grid_best(spark, d):
    """The best setting on validation, scored on test."""
    return evaluate.best_damping(*_three_parts(spark, d), DAMPINGS, digits=6)


@query("damped_two_way")
def damped_two_way(spark, d):
    """The grid over a U2 split, scored where it was chosen."""
    train, test = _parts(_two_way(spark, d), ("train", "test"))
    return evaluate.best_damping(train, test, test, DAMPINGS, digits=6)


# --- re-ranking -------------------------------------------------------------------

@query("recent_ratings")
def recent_ratings(spark, d):
    """The 20 latest rating events of every user."""
    return rerank.recent_ratings(views.stream_events(spark, d), 20)


@query("stream_candidates")
def stream_candidates(spark, d):
    """Per event, the 20 most similar items the user has not rated."""
    ev = views.stream_events(spark, d)
    return rerank.candidates(ev, _vector_sims(spark, d), views.ratings(spark, d), 20)


@query("seen_filter")
def seen_filter(spark, d):
    """Rating events for items the user had not rated before."""
    ev = views.stream_events(spark, d).select("event_id", "uid", "mid")
    return ev.join(views.ratings(spark, d).select("uid", "mid"), ["uid", "mid"], "left_anti")


@query("stream_recs_batch")
def stream_recs_batch(spark, d):
    """T3 as a batch plan: J8, F4, F6, A9, X6 with gate 0.2 on embedding sims."""
    return rerank.recommend_from_events(views.stream_events(spark, d),
                                        saved(_vector_sims(spark, d), "all-sims"),
                                        views.ratings(spark, d), gate=0.2, digits=6)


@query("stream_recs_ordered")
def stream_recs_ordered(spark, d):
    """O3: the position of every item in its user's nested list."""
    ev = views.stream_events(spark, d)
    scores = rerank.recommend_from_events(ev, saved(_vector_sims(spark, d), "all-sims"),
                                          views.ratings(spark, d), gate=0.2, digits=6)
    return topk.explode_recs(rerank.nest_user_recs(ev, scores), "uid", item_alias="mid")


# --- sources: text formats written from the views and parsed back ----------------

def _round_trip_text(spark, name, lines_df):
    path = scratch_path(spark, name)
    lines_df.write.mode("overwrite").text(path)
    return path


def _s(c):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


@query("parse_movie_text")
def parse_movie_text(spark, d):
    """S1, X1, X2: '^'-separated movie lines, all ten fields padded with blanks
    and tabs -> typed movies."""
    m = views.movies(spark, d)
    filled = {"mid": _s("mid"), "name": _s("name"), "genres": _s("genres")}
    fields = [filled.get(f, F.concat(F.lit(f"{f} of "), _s("mid"))) for f in MOVIE_FIELDS]
    line = F.concat_ws("^", *[F.concat(F.lit(" \t"), c, F.lit("\t ")) for c in fields])
    path = _round_trip_text(spark, "movies-text", m.select(line.alias("value")))
    good, _bad = sources.read_movies_text(spark, path)
    return good


@query("parse_ratings_csv")
def parse_ratings_csv(spark, d):
    """S2: 'uid,mid,score,ts' lines -> typed ratings."""
    r = views.ratings(spark, d)
    line = F.concat_ws(",", _s("uid"), _s("mid"), _s("score"), _s("ts"))
    path = _round_trip_text(spark, "ratings-csv", r.select(line.alias("value")))
    return sources.read_ratings_csv(spark, path)[0]


@query("parse_tags_csv")
def parse_tags_csv(spark, d):
    """S3: 'uid,mid,tag,ts' lines (tag padded) -> typed tags."""
    t = views.tags(spark, d)
    line = F.concat_ws(",", _s("uid"), _s("mid"), F.concat(F.lit(" "), _s("tag")), _s("ts"))
    path = _round_trip_text(spark, "tags-csv", t.select(line.alias("value")))
    return sources.read_tags_csv(spark, path)[0]


@query("parse_tab_ratings")
def parse_tab_ratings(spark, d):
    """Tab-separated 'user item rating time' -> (uid, mid, score)."""
    r = views.ratings(spark, d)
    line = F.concat_ws("\t", _s("uid"), _s("mid"), _s("score"), _s("ts"))
    path = _round_trip_text(spark, "ratings-tab", r.select(line.alias("value")))
    return sources.read_tab_ratings(spark, path)[0]


@query("parse_item_titles")
def parse_item_titles(spark, d):
    """S5: 'id|title|genres...' lines -> (mid, name); later fields ignored."""
    m = views.movies(spark, d)
    line = F.concat_ws("|", _s("mid"), _s("name"), _s("genres"))
    path = _round_trip_text(spark, "item-titles", m.select(line.alias("value")))
    return sources.read_item_titles(spark, path)[0]


@query("parse_rating_messages")
def parse_rating_messages(spark, d):
    """S9, T2: 'UID|MID|SCORE|TIMESTAMP' message values -> typed ratings."""
    ev = views.stream_events(spark, d)
    msgs = ev.select(F.concat_ws("|", _s("uid"), _s("mid"), _s("score"), _s("ts"))
                     .alias("value"))
    return sources.parse_rating_messages(msgs)[0]


@query("parse_recent_lists")
def parse_recent_lists(spark, d):
    """S8 (encoded), X8: per-user lists 'uid:<uid>' -> ['MID:SCORE', ...] built
    from the events, newest first, in rows of 1,000 entries; then read back: the
    first 20 entries."""
    lists = sources.encode_recent_lists(views.stream_events(spark, d))
    return sources.parse_recent_lists(lists, k=20, chunk_col="chunk")[0]


# --- sinks -------------------------------------------------------------------------

@query("sink_overwrite")
def sink_overwrite(spark, d):
    """Overwrite a table (twice), read it back by format + schema."""
    r = views.ratings(spark, d)
    path = scratch_path(spark, "overwrite")
    sources.write_table(stats.item_average(r), path)
    sources.write_table(stats.item_popularity(r), path)  # replaces the first table
    return sources.read_table(spark, "parquet", path,
                              schema=T.StructType([T.StructField("mid", T.IntegerType()),
                                                   T.StructField("count", T.LongType())]))


@query("sink_keyed_docs")
def sink_keyed_docs(spark, d):
    """K2: movies with tags as JSON documents keyed by mid, read back."""
    docs = tagops.items_with_tags(views.movies(spark, d), views.tags(spark, d))
    path = scratch_path(spark, "keyed-docs")
    sources.write_keyed_docs(docs, "mid", path, [F.asc("name"), F.asc("genres"), F.asc("tags")])
    schema = "mid int, name string, genres string, tags string"
    return spark.read.schema(schema).json(path)


@query("sink_upsert")
def sink_upsert(spark, d):
    """Per-user recommendation lists upserted in two batches.

    Batch 0 holds every user's list from the first half of the events,
    batch 1 the lists (from all events) of users active in the second half;
    the latest row per user wins, so the result equals the batch query.
    """
    ev = views.stream_events(spark, d)
    half = ev.agg(F.max("event_id")).first()[0] // 2
    sims_path = scratch_path(spark, "sims")
    sources.write_table(_vector_sims(spark, d), sims_path)
    sims = spark.read.parquet(sims_path)
    seen = views.ratings(spark, d)
    path = scratch_path(spark, "upsert")
    for b, part, users in ((0, ev.where(F.col("event_id") <= half), None),
                           (1, ev, ev.where(F.col("event_id") > half))):
        scores = rerank.recommend_from_events(part, sims, seen, gate=0.2, digits=6)
        who = (users if users is not None else part).select("uid")
        sources.upsert_log_write(rerank.nest_user_recs(who, scores), path, b)
    latest = sources.upsert_log_read(spark, path, "uid")
    return topk.explode_recs(latest, "uid", item_alias="mid", rank_col=None)


def _lookups(spark, d):
    """Similar items and rated items as clustered tables: two readers."""
    sims_path, seen_path = scratch_path(spark, "sims"), scratch_path(spark, "seen")
    sources.write_clustered(saved(_vector_sims(spark, d), "all-sims"), sims_path, "mid")
    sources.write_clustered(views.ratings(spark, d).select("uid", "mid"), seen_path, "uid")
    return (lambda: sources.read_clustered(spark, sims_path),
            lambda: sources.read_clustered(spark, seen_path))


#: Rows of a replayed event file, and files of a micro-batch: each batch reads the
#: lookups at hand and runs a dozen short jobs, so it takes up to a million events.
EVENTS_PER_FILE = 250_000
FILES_PER_BATCH = 4


def _replayed(spark, d, trigger):
    """Events replayed from files, as many as their rows need, through recent state,
    foreachBatch re-ranking and the upsert log."""
    from recspark.streaming.recommender import StreamRecommender, file_rating_events
    ev_path = scratch_path(spark, "events")
    (views.stream_events(spark, d).write.option("maxRecordsPerFile", EVENTS_PER_FILE)
     .mode("overwrite").parquet(ev_path))
    sims, seen = _lookups(spark, d)
    rec = StreamRecommender(sims, seen, scratch_path(spark, "stream-recs"), gate=0.2, digits=6)
    q = rec.start(file_rating_events(spark, ev_path, max_files_per_trigger=FILES_PER_BATCH),
                  checkpoint=scratch_path(spark, "stream-ckpt"), trigger=trigger)
    if trigger and "availableNow" in trigger:
        q.awaitTermination()
    else:
        try:
            q.processAllAvailable()            # all files are there before the start
        finally:
            q.stop()
    return topk.explode_recs(rec.read_recs(spark), "uid", item_alias="mid", rank_col=None)


@query("stream_recs")
def stream_recs(spark, d):
    """The replayed events, as fast as batches go."""
    return _replayed(spark, d, {"availableNow": True})


@query("stream_recs_2s")
def stream_recs_2s(spark, d):
    """The same with the trigger of the original, a batch every two seconds."""
    return _replayed(spark, d, None)


def _message_stream(spark, d):
    """Messages of all events, every seventh followed by a broken one, through
    the stream; returns (recommender, quarantine path)."""
    from recspark.streaming.recommender import StreamRecommender, text_rating_events
    ev = views.stream_events(spark, d)
    line = F.concat_ws("|", *[_s(c) for c in ("uid", "mid", "score", "ts", "event_id")])
    broken = F.concat_ws("|", _s("uid"), F.lit("no item"), _s("score"), _s("ts"), _s("event_id"))
    lines = ev.select(line.alias("value")).union(
        ev.where("event_id % 7 = 0").select(broken.alias("value")))
    path = scratch_path(spark, "messages")
    lines.write.option("maxRecordsPerFile", EVENTS_PER_FILE).text(path)
    good, bad = text_rating_events(spark, path, max_files_per_trigger=FILES_PER_BATCH)
    sims, seen = _lookups(spark, d)
    rec = StreamRecommender(sims, seen, scratch_path(spark, "stream-recs"), gate=0.2, digits=6)
    aside = scratch_path(spark, "quarantine")
    now = {"availableNow": True}
    queries = [rec.start(good, checkpoint=scratch_path(spark, "stream-ckpt"), trigger=now),
               rec.start_quarantine(bad, aside, scratch_path(spark, "bad-ckpt"), trigger=now)]
    for q in queries:
        q.awaitTermination()
    return rec, aside


@query("stream_recs_messages")
def stream_recs_messages(spark, d):
    """S9, T1-T6 end to end: message text -> parse -> state -> recommendations."""
    rec, _ = _message_stream(spark, d)
    return topk.explode_recs(rec.read_recs(spark), "uid", item_alias="mid", rank_col=None)


@query("stream_quarantine")
def stream_quarantine(spark, d):
    """The messages that went aside, with the reason."""
    _, aside = _message_stream(spark, d)
    return spark.read.schema("line string, reason string").parquet(aside)


# --- scoring with given factors ----------------------------------------------------

def _factors(spark, d):
    """Factor rows (id, vector) made of the embeddings."""
    return views.embeddings(spark, d).select(F.col("mid").alias("id"),
                                             F.col("features").alias("vector"))


def _rounded(df, col="score"):
    return df.withColumn(col, evaluate.round_half_up(col, 6))


@query("als_input")
def als_input(spark, d):
    """What a fit reads."""
    return factors.als_input(views.ratings(spark, d))


@query("factor_user_recs")
def factor_user_recs(spark, d):
    """The 20 best items of every user vector, positive scores only."""
    f = _factors(spark, d)
    return _rounded(factors.best_matches(f, f, 20, positive=True)).select(
        F.col("id").cast("int").alias("uid"), "rk", F.col("other").cast("int").alias("mid"), "score")


@query("factor_recs_for_users")
def factor_recs_for_users(spark, d):
    """The ten best items of users with an event, with titles."""
    f = _factors(spark, d)
    return _rounded(factors.recs_for(f, f, views.stream_events(spark, d).select("uid"), "uid",
                                     "mid", views.movies(spark, d), INTERACTIVE_K))


@query("factor_recs_for_items")
def factor_recs_for_items(spark, d):
    """The ten best users of tagged items, with titles."""
    f = _factors(spark, d)
    return _rounded(factors.recs_for(f, f, views.tags(spark, d).select("mid"), "mid", "uid",
                                     views.movies(spark, d), INTERACTIVE_K))


@query("factor_predictions")
def factor_predictions(spark, d):
    """V7: predictions for rating events; NULL where an id has no vector."""
    f = _factors(spark, d)
    ev = views.stream_events(spark, d).select("event_id", "uid", "mid")
    return _rounded(factors.predict_pairs(f, f, ev), "prediction")


# --- factor models (rows-only checks) -------------------------------------------

def _fitted(spark, d, setting):
    return factors.fit_als(views.ratings(spark, d), setting["rank"], setting["max_iter"],
                           setting["reg_param"])


@query("als_user_recs")
def als_user_recs(spark, d):
    """Rank 200 / 5 iterations / 0.1, top 20 items per user."""
    return factors.user_recs(_fitted(spark, d, OFFLINE_ALS), 20)


@query("als_item_similar")
def als_item_similar(spark, d):
    """Items with factor cosine > 0.6, best 20 each."""
    return factors.item_similar(_fitted(spark, d, OFFLINE_ALS), floor=0.6, k=20)


@query("als_recs_for_users")
def als_recs_for_users(spark, d):
    """Top 10 items with titles for every user with a rating event."""
    return factors.recs_for_users(_fitted(spark, d, INTERACTIVE_ALS),
                                  views.stream_events(spark, d).select("uid"),
                                  views.movies(spark, d))


@query("als_recs_for_items")
def als_recs_for_items(spark, d):
    """Top 10 users for every tagged item, with the item title."""
    return factors.recs_for_items(_fitted(spark, d, INTERACTIVE_ALS),
                                  views.tags(spark, d).select("mid"), views.movies(spark, d))


@query("als_param_sweep")
def als_param_sweep(spark, d):
    """The 16 settings of the one-parameter sweeps on an 8:1:1 split."""
    train, valid, _ = _three_parts(spark, d)
    return evaluate.param_sweep(train, valid)


@query("als_grid_best")
def als_grid_best(spark, d):
    """The 125 settings in one run, the best one's RMSE on test."""
    return evaluate.train_validate_test(*_three_parts(spark, d))
