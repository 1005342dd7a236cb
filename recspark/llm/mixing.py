"""Mixing sources to target weights by Poisson replication.

A source with ``n`` documents and share ``s`` of the target size ``t`` has the
mean repetition rate ``t * s / n``.  Every document draws its number of copies
from the Poisson distribution with that mean: a uniform number hashed from the
seed and the document is inverted through the distribution function.  Copies
are then put in a global random order by a range partition on a hashed key.  A mean
above ``MAX_MEAN`` is drawn as a sum of parts with equal smaller means, so the
literals of the distribution do not grow with the table.

The draw of a document depends on its id, the seed and its source's rate only,
never on its place in a file, so a lost task gives the same copies again.  Rows
that share an id share the order key too; behind it the ranges are cut by the
text's hash and the input partition, so they spread over tasks.

Defined results: a source that is not listed, null among them, belongs to one
pooled rest with ``other_weight``; a document without an id draws by its text;
equal rows draw alike; a source with no document gives its share to nobody;
an empty table gives no rows.  Added columns replace those of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HEX = 13
#: Largest mean inverted in one draw.
MAX_MEAN = 64.0
#: Copies expanded from one row at once.
COPY_CHUNK = 10_000


def poisson_cdf(mean: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until the rest is below one part in 2**53."""
    if mean <= 0:
        return [1.0]
    out, total, k = [], 0.0, 0
    while True:
        total += math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1))
        out.append(min(total, 1.0))
        if k > mean and 1.0 - total < 2.0 ** -53 or k > mean + 40 * math.sqrt(mean) + 60:
            return out
        k += 1


def _draw_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"),
                      F.concat(F.lit("t"), F.md5(F.coalesce(F.col("text"), F.lit(""))
                                                 .cast("binary"))))


def hashed_unit(seed: str, key: Column) -> Column:
    """A number in (0, 1) from the seed and a string key, 52 bits of it."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + "|"), key).cast("binary")), 1, _HEX)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16 ** _HEX))


def source_rates(docs: DataFrame, weights: Mapping[str, float], other_weight: float,
                 epochs: float) -> dict[str | None, float]:
    """Mean copies of a document by listed source; None: all other sources.

    One row for each listed source and one for the rest reach the driver.
    """
    listed = F.when(F.col("source").isin(*weights), F.col("source"))
    counts = {r[0]: r[1] for r in docs.groupBy(listed.alias("s")).count().collect()}
    goal = {**{s: float(w) for s, w in weights.items()}, None: float(other_weight)}
    present = {s: w for s, w in goal.items() if counts.get(s)}
    total, share = sum(counts.values()), sum(present.values())
    return {s: epochs * total * w / share / counts[s] if share > 0 else 0.0
            for s, w in present.items()}


def mix_sources(docs: DataFrame, weights: Mapping[str, float], other_weight: float = 1.0,
                epochs: float = 1.0, seed: str = "mix", detail: bool = False) -> DataFrame:
    """The copies of all documents in a global random order.

    With ``detail`` adds ``copy`` (0 for the first), ``n_copies`` and
    ``mix_key``, the order of rows across and inside the output partitions.
    """
    rates = source_rates(docs, weights, other_weight, epochs)
    added = ["copy", "n_copies", "mix_key"] if detail else []
    kept = [c for c in docs.columns if c not in added]

    def copies(rate: float) -> Column:
        parts = max(1, math.ceil(rate / MAX_MEAN))
        below = F.array(*[F.lit(c) for c in poisson_cdf(rate / parts)])

        def drawn_by(u: Column) -> Column:
            return F.size(F.filter(below, lambda c: c <= u))

        first = drawn_by(F.col("__mix_u"))
        if parts == 1:
            return first
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(parts - 1)), first,
            lambda total, part: total + drawn_by(hashed_unit(
                f"{seed}-part", F.concat(part.cast("string"), F.lit("|"), F.col("__mix_id")))))

    n = copies(rates.get(None, 0.0))
    for s, rate in rates.items():
        if s is not None:
            n = F.when(F.col("source") == F.lit(s), copies(rate)).otherwise(n)
    key = F.md5(F.concat(F.lit(f"{seed}-order|"), F.col("__mix_id"), F.lit("|"),
                         F.col("__mix_copy").cast("string")).cast("binary"))
    upto = F.least(F.col("__mix_chunk") + COPY_CHUNK, F.col("__mix_n")) - 1
    drawn = (docs.select(*kept).withColumn("__mix_id", _draw_key())
             .withColumn("__mix_u", hashed_unit(seed, F.col("__mix_id")))
             .withColumn("__mix_n", n).where("__mix_n > 0")
             .withColumn("__mix_row", F.xxhash64("__mix_id", "text"))
             .withColumn("__mix_part", F.spark_partition_id()))
    if max(rates.values(), default=0.0) > MAX_MEAN:
        drawn = (drawn.withColumn("__mix_chunk", F.explode(F.sequence(
                     F.lit(0), F.col("__mix_n") - 1, F.lit(COPY_CHUNK))))
                 .withColumn("__mix_copy", F.explode(F.sequence("__mix_chunk", upto))))
    else:
        drawn = drawn.withColumn("__mix_copy",
                                 F.explode(F.sequence(F.lit(0), F.col("__mix_n") - 1)))
    order = ["__mix_key", "__mix_row", "__mix_part"]
    ordered = (drawn.withColumn("__mix_key", key).repartitionByRange(*order)
               .sortWithinPartitions(*order))
    names = {"copy": "__mix_copy", "n_copies": "__mix_n", "mix_key": "__mix_key"}
    return ordered.select(*kept, *(F.col(names[c]).alias(c) for c in added))
