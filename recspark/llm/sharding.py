"""Weighted rendezvous hashing of record keys over shards, with gapless slots.

A key goes to the shard with the largest score ``ln(u) / weight``, where ``u``
in (0, 1) is hashed from the key and the shard number.  A further shard only
adds one more score to the comparison, so rows move into it alone; its share
of the keys is its share of the weight.

Defined results: a null key is a key of its own; rows with equal keys go to one
shard; an empty table gives no rows; columns that the operator adds replace
columns of the same name.  No shuffle is needed for the shard itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Hex digits of the digest that make ``u``: 52 bits, exact in a double.
_HEX = 13
#: Rows numbered together; the number of groups grows with the table.
SLOT_GROUP_ROWS = 2_000
#: Copies of one row expanded from one row.
COPY_CHUNK = 10_000


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to ``len(weights) - 1``) of a string key; ties go to the
    smaller number."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = []
    for i, w in enumerate(weights):
        digits = F.substring(F.md5(F.concat(F.lit(f"{i}|"), key).cast("binary")), 1, _HEX)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16 ** _HEX))
        scores.append(F.struct((F.log(u) / F.lit(float(w))).alias("s"),
                               F.lit(-i).alias("i")))
    best = F.array_max(F.array(*scores))
    return (-best["i"]).cast("int")


def key_text(column: str) -> Column:
    """A record key as text; null has a text that no key has."""
    return F.coalesce(F.concat(F.lit("k"), F.col(column).cast("string")), F.lit("null"))


def assign_shards(df: DataFrame, key: str, weights: Sequence[float],
                  shard_col: str = "shard") -> DataFrame:
    """Every row of ``df`` with its shard."""
    return df.withColumn(shard_col, shard_of(key_text(key), weights))


def with_slots(df: DataFrame, shard_col: str, slot_col: str = "slot") -> DataFrame:
    """Number the rows of each shard 0, 1, 2, ... without a task per shard.

    Equal rows are counted before the shuffle, rows of a shard are dealt to
    groups by hash, numbered inside their group, and shifted by the rows of the
    groups before it.  The numbers depend on the rows alone.
    """
    cols = [c for c in df.columns if c != slot_col]
    total = df.count()
    n_groups = max(1, -(-total // SLOT_GROUP_ROWS))
    rows = (df.select(*cols)
            .withColumn("_g", F.pmod(F.xxhash64(*cols), F.lit(n_groups)))
            .groupBy(*cols, "_g").agg(F.count(F.lit(1)).alias("_n")))
    sizes = rows.groupBy(shard_col, "_g").agg(F.sum("_n").alias("_size"))
    before = W.partitionBy(shard_col).orderBy("_g").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(shard_col, "_g",
                          F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = (W.partitionBy(shard_col, "_g").orderBy(*cols)
              .rowsBetween(W.unboundedPreceding, -1))
    placed = (rows.withColumn("_at", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
              .join(starts, [shard_col, "_g"]))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1,
                                 F.lit(COPY_CHUNK).cast("long")))
    copy = F.explode(F.sequence(F.col("_c"),
                                F.least(F.col("_c") + COPY_CHUNK, F.col("_n")) - 1))
    return (placed.withColumn("_c", chunk).withColumn("_i", copy)
            .select(*cols, (F.col("_start") + F.col("_at") + F.col("_i")).cast("long")
                    .alias(slot_col)))


def shard_documents(docs: DataFrame, weights: Sequence[float],
                    grown_weight: float = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, grown_shard and slot of every row.

    ``size`` is the text's UTF-8 bytes plus 1; a null text has none, and the
    checksum of no bytes.  ``grown_shard`` is the shard with one more of
    ``grown_weight``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = key_text("doc_id")
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, grown_weight]).alias("grown_shard"))
    return with_slots(rows, "shard").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
