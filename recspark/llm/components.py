"""Connected components of a graph given by an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every end of an edge; component is the smallest id.

    Each round every node takes the smallest label among its neighbours and
    itself, then the label of its label, until nothing changes.  Labels are
    written to the shared folder each round; only counts reach the driver.
    """
    both = materialize(
        edges.select(F.col(a).alias("s"), F.col(b).alias("t"))
        .union(edges.select(F.col(b), F.col(a))).where("s <> t").distinct(), "edges")
    labels = materialize(both.groupBy("s").agg(F.min("t").alias("m"))
                         .select(F.col("s").alias("id"), F.least("s", "m").alias("c")), "labels")
    while True:
        heard = (both.join(labels.select(F.col("id").alias("t"), "c"), "t")
                 .groupBy(F.col("s").alias("id")).agg(F.min("c").alias("heard")))
        near = (labels.join(heard, "id")
                .select("id", F.col("c").alias("old"), F.least("c", "heard").alias("c")))
        jump = labels.select(F.col("id").alias("c"), F.col("c").alias("far"))
        step = materialize(near.join(jump, "c", "left")
                           .select("id", "old", F.least("c", "far").alias("c")), "labels")
        if step.where("c <> old").limit(1).count() == 0:
            return step.select("id", F.col("c").alias("component"))
        labels = step.select("id", "c")
