"""Tag aggregation and the movie-with-tags join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tags_per_item(tags: DataFrame) -> DataFrame:
    """A4: (mid, tags) with tags = sorted distinct tags joined by '|'.

    Deduplicated on (mid, tag) first, so the per-item list that reaches one
    task is bounded by the item's distinct tags, not its tag events.
    """
    return (tags.select("mid", "tag").where(F.col("tag").isNotNull()).distinct()
            .groupBy("mid")
            .agg(F.concat_ws("|", F.array_sort(F.collect_list("tag"))).alias("tags")))


def items_with_tags(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """J2 + P3: every movie with its tag string (NULL when it has none)."""
    return movies.join(tags_per_item(tags), ["mid"], "left")
