"""Declared schemas and the fixed values the recommender semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original job's constants for equal results)
# ---------------------------------------------------------------------------
# Genre names used for the per-genre top list, in their original order.
DEFAULT_GENRES = [
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary",
    "Drama", "Family", "Fantasy", "Foreign", "History", "Horror", "Music",
    "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
]
GENRE_TOP_K = 10            # items per genre
USER_RECS_K = 20            # items per user (offline ALS)
ITEM_SIMS_K = 20            # similar items kept per item
ITEM_SIM_FLOOR = 0.6        # strict lower bound on cosine for similar items
STREAM_RECENT_K = 20        # recent ratings per user used for re-ranking
STREAM_CANDIDATES_K = 20    # candidate items per event
STREAM_SIM_GATE = 0.7       # strict lower bound on similarity when scoring
LIKE_THRESHOLD = 3.0        # score > 3 is a like, otherwise a dislike
HASHING_TF_FEATURES = 50    # buckets of the hashed term frequencies
OFFLINE_ALS = dict(rank=200, max_iter=5, reg_param=0.1)
INTERACTIVE_ALS = dict(rank=15, max_iter=20, reg_param=0.1)
SWEEP_RANKS = [5, 10, 15, 20, 50, 100]
SWEEP_ITERATIONS = [5, 10, 15, 20, 25]
SWEEP_LAMBDAS = [0.05, 0.1, 1.0, 5.0, 10.0]
SWEEP_FIXED = dict(rank=10, max_iter=10, reg_param=0.1)
GRID_RANKS = [5, 10, 15, 20, 25]
GRID_ITERATIONS = [5, 10, 15, 20, 25]
GRID_LAMBDAS = [0.05, 0.1, 1.0, 5.0, 10.0]
INTERACTIVE_K = 10          # items for a user / users for an item
# Output table names of the original jobs.
TABLE_MOVIE = "Movie"
TABLE_RATING = "Rating"
TABLE_TAG = "Tag"
TABLE_MOVIE_WITH_TAGS = "MovieWithTags"
TABLE_RATE_MORE = "RateMoreMovies"
TABLE_RATE_MORE_RECENTLY = "RateMoreRecentlyMovies"
TABLE_AVERAGE = "AverageMovies"
TABLE_GENRES_TOP = "GenresTopMovies"
TABLE_USER_RECS = "UserRecs"
TABLE_MOVIE_RECS = "MovieRecs"
TABLE_CONTENT_RECS = "ContentMovieRecs"
TABLE_STREAM_RECS = "StreamRecs"
# Field separators of the text formats.
MOVIE_SEP = "^"
RATING_SEP = ","
TAB_SEP = "\t"
ITEM_SEP = "|"
MESSAGE_SEP = "|"
RECENT_SEP = ":"

# ---------------------------------------------------------------------------
# Table schemas
# ---------------------------------------------------------------------------
MOVIE_FIELDS = ["mid", "name", "descri", "timelong", "issue", "shoot",
                "language", "genres", "actors", "directors"]
MOVIE = T.StructType(
    [T.StructField("mid", T.IntegerType())]
    + [T.StructField(f, T.StringType()) for f in MOVIE_FIELDS[1:]]
)
RATING = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ts", T.IntegerType()),  # epoch seconds ("timestamp" originally)
])
TAG = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("ts", T.IntegerType()),  # epoch seconds ("timestamp" originally)
])
REC = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])
RECS = T.ArrayType(REC)
USER_RECS = T.StructType([T.StructField("uid", T.IntegerType()),
                          T.StructField("recs", RECS)])
MOVIE_RECS = T.StructType([T.StructField("mid", T.IntegerType()),
                           T.StructField("recs", RECS)])
GENRE_RECS = T.StructType([T.StructField("genres", T.StringType()),
                           T.StructField("recs", RECS)])
