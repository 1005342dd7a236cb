"""Line de-duplication that ships hashes of lines and returns keep bitmaps.

A line's key is the line without white space at its ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points go as 128-bit hashes, with document
and position, to range partitions sorted by hash, document and position.  The
range is cut on the document too, so a line that fills a third of the table
spreads over many tasks.  In that order first occurrences in a document are
streamed; a partial aggregation sums them by key.  A key goes back only to the
range partitions that hold it, by their numbers, so its lines stay spread where
the bitmaps are made.  What returns to a document is one small bitmap of kept lines, as alternating run lengths
(kept, dropped, kept, ...), never text.

Defined results: a null or empty text is one empty line, and a null text stays
null; rows with an equal id count as one document, also all rows without an id,
which never hold the kept copy; lines are cut at \\n alone; equal rows get equal
bitmaps; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import LOWER, SPACE_CHARS, UPPER, materialize

MIN_CHARS = 40
MIN_DOCS = 5


def lines_of(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), UPPER, LOWER)


def _row_id(text: str = "text") -> Column:
    """Tells apart rows with the same document id."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def line_occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, row_id, pos, first, part) of every line with a long enough key.

    ``first`` marks the first of a document's lines with that key (of a row's,
    without an id); ``part`` is the number of the line's range partition.
    """
    lines = (docs.select("doc_id", _row_id().alias("row_id"),
                         F.posexplode(lines_of()).alias("pos", "line"))
             .withColumn("key", line_key(F.col("line")))
             .where(F.char_length("key") >= min_chars)
             .select(F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit("line"), "key").alias("h2"),
                     "doc_id", "row_id", "pos",
                     F.when(F.col("doc_id").isNull(), F.col("row_id")).alias("own")))
    in_order = lines.repartitionByRange("h1", "h2", "doc_id", "own")
    per_doc = W.partitionBy("h1", "h2", "doc_id", "own").orderBy("pos", "row_id")
    return (in_order.withColumn("first", F.row_number().over(per_doc) == 1).drop("own")
            .withColumn("part", F.spark_partition_id()))


def repeated_keys(occurrences: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, part, keep_doc) of the keys found in at least ``min_docs`` documents,
    once for every range partition that holds the key.

    A key's partitions follow one another, so the first and the last tell them.
    """
    no_id = F.col("doc_id").isNull()
    return (occurrences.groupBy("h1", "h2")
            .agg((F.sum((F.col("first") & ~no_id).cast("long"))
                  + F.max(no_id.cast("long"))).alias("n_docs"),
                 F.max("doc_id").alias("keep_doc"),
                 F.min("part").alias("_from"), F.max("part").alias("_to"))
            .where(F.col("n_docs") >= min_docs)
            .select("h1", "h2", "keep_doc",
                    F.explode(F.sequence("_from", "_to")).alias("part")))


def _runs_of_dropped(d: Column) -> Column:
    """Sorted positions -> array of (start, end), end exclusive."""
    def cut(p: Column) -> Column:
        starts = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
        ends = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) != x + 1))
        return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), (e + 1).alias("e")))
    return F.transform(F.array(d), cut)[0]


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row_id, keep_runs) of every row that loses a line.

    ``keep_runs`` starts with a number of kept lines (perhaps 0), then dropped,
    then kept, ...; lines after the last run are kept.
    """
    occ = materialize(line_occurrences(docs, min_chars), "lines")
    dropped = (occ.join(repeated_keys(occ, min_docs), ["part", "h1", "h2"])
               .where(~F.col("doc_id").eqNullSafe(F.col("keep_doc")))
               .groupBy("doc_id", "row_id")
               .agg(F.array_sort(F.collect_set("pos")).alias("d")))
    runs = F.transform(F.array(_runs_of_dropped(F.col("d"))), lambda r: F.flatten(F.transform(
        r, lambda x, i: F.array(
            x["s"] - F.when(i > 0, F.get(r, i - 1)["e"]).otherwise(F.lit(0)),
            x["e"] - x["s"]))))[0]
    return dropped.select("doc_id", "row_id", runs.alias("keep_runs"))


def _kept_text(lines: Column, runs: Column) -> Column:
    flags = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    pairs = F.arrays_zip(lines.alias("line"), flags.alias("keep"))
    kept = F.filter(pairs, lambda x: F.coalesce(x["keep"], F.lit(True)))
    return F.array_join(F.transform(kept, lambda x: x["line"]), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                detail: bool = False) -> DataFrame:
    """``docs`` with the dropped lines cut out of ``text``.

    With ``detail`` also ``n_lines`` (before), ``n_dropped`` and ``keep_runs``
    (null: all lines kept).  ``n_chars``, where there is one, follows the text.
    """
    added = ("n_lines", "n_dropped", "keep_runs")
    cols = [c for c in docs.columns if not (detail and c in added)]
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("__ld_doc"), F.col("row_id").alias("__ld_id"),
        F.col("keep_runs").alias("__ld_runs"))
    both = (docs.select(*cols).withColumn("__ld_row", _row_id())
            .join(bitmaps.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__ld_doc"))
                  & (F.col("__ld_row") == F.col("__ld_id")), "left"))
    runs = F.col("__ld_runs")
    out = both.withColumn("__ld_text", F.when(runs.isNull(), F.col("text"))
                          .otherwise(_kept_text(lines_of(), runs)))
    made = {"text": F.col("__ld_text"), "n_chars": F.char_length("__ld_text").cast("long")}
    picked = [made[c].alias(c) if c in made else F.col(c) for c in cols]
    if detail:
        n_dropped = F.aggregate(
            F.transform(runs, lambda n, i: F.when(i % 2 == 1, n).otherwise(F.lit(0))),
            F.lit(0), lambda a, n: a + n)
        picked += [F.size(lines_of()).cast("long").alias("n_lines"),
                   F.coalesce(n_dropped, F.lit(0)).cast("long").alias("n_dropped"),
                   runs.alias("keep_runs")]
    return out.select(*picked)
