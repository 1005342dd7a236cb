"""Top-k per key (W1-W6), nesting to recommendation lists (A5) and back.

``row_number() <= k`` is planned by Spark as a WindowGroupLimit that runs once
before the shuffle (partial) and once after (final), so a key holding a third
of all rows sends at most ``k`` rows per map partition through the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list:
    if isinstance(cs, (str, Column)):
        return [cs]
    return list(cs)


def top_k_per_key(df: DataFrame, keys, order: Sequence[Column], k: int | None,
                  rank_col: str = "rk") -> DataFrame:
    """Rank rows within each key by ``order``; keep ranks <= k (all if None)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    # Ranks are BIGINT: an uncut (k=None) group may exceed the INT range.
    out = df.withColumn(rank_col, F.row_number().over(w).cast("long"))
    if k is not None:
        out = out.filter(F.col(rank_col) <= k)
    return out


def nest_recs(df: DataFrame, key: str, item_col: str = "mid",
              score_col: str = "score", rank_col: str = "rk",
              out_col: str = "recs") -> DataFrame:
    """A5: flat ranked rows -> one row per key with ARRAY<STRUCT<mid, score>>.

    Apply after a top-k cut: the list of a key is as long as its ranked rows.
    """
    packed = F.struct(F.col(rank_col).alias("rk"), F.col(item_col).alias("mid"),
                      F.col(score_col).alias("score"))
    return (df.groupBy(key)
            .agg(F.array_sort(F.collect_list(packed)).alias("_l"))
            .select(key, F.transform("_l", lambda s: F.struct(
                s["mid"].alias("mid"), s["score"].alias("score"))).alias(out_col)))


def explode_recs(df: DataFrame, key: str, recs_col: str = "recs",
                 item_alias: str = "sim_mid", rank_col: str | None = "rk") -> DataFrame:
    """Nested lists -> long form (key, rk, item, score); rank is 1-based."""
    out = df.select(key, F.posexplode(recs_col).alias("_pos", "_r"))
    cols = [F.col(key)]
    if rank_col:
        cols.append((F.col("_pos").cast("long") + 1).alias(rank_col))
    cols += [F.col("_r.mid").alias(item_alias), F.col("_r.score").alias("score")]
    return out.select(*cols)


def dedupe_last_wins(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """One row per key, the one ranked first by ``order``."""
    return top_k_per_key(df, keys, order, 1, "_rk1").drop("_rk1")
