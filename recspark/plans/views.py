"""Recommender-shaped views over the generated test tables.

ratings  <- lineitem x orders  (uid = customer, mid = part, half-step scores)
movies   <- part               (genres = type | first word | second word)
tags     <- events             (mid = props.k, tag = event type)
stream   <- events             (rating events; event_id is a dense position)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions import epoch_seconds
from recspark.schema import DEFAULT_GENRES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, mid, score, ts) - one rating per line item."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey",
                                                 "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").cast("int").alias("uid"),
                    F.col("l_partkey").cast("int").alias("mid"),
                    (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("score"),
                    epoch_seconds("l_shipdate").alias("ts")))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, name, genres)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws("|", "p_type", F.split_part("p_name", F.lit(" "), F.lit(1)),
                    F.split_part("p_name", F.lit(" "), F.lit(2))).alias("genres"))


def movies_with_default_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, name, genres): two genres of the default list, by the item's id."""
    names = F.array(*[F.lit(g) for g in DEFAULT_GENRES])
    mid = F.col("p_partkey").cast("int")
    pick = lambda n: F.get(names, F.pmod(mid * n, F.lit(len(DEFAULT_GENRES))))
    return table(spark, sf_dir, "part").select(
        mid.alias("mid"), F.col("p_name").alias("name"),
        F.concat_ws("|", pick(1), pick(7)).alias("genres"))


def _props_k():
    return F.get_json_object("props", "$.k").cast("int")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, mid, tag, ts)."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("uid"), _props_k().alias("mid"),
        F.col("event_type").alias("tag"), epoch_seconds("ts").alias("ts"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, uid, mid, score, ts): rating events in arrival order."""
    score = F.least(F.lit(5.0), F.greatest(
        F.lit(0.5), F.ceil(F.col("value") / 10).cast("double") / 2))
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("int").alias("uid"), _props_k().alias("mid"),
        score.alias("score"), epoch_seconds("ts").alias("ts"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, features) item vectors."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("mid"), F.col("embedding").alias("features"))
