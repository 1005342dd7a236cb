"""The corpus pipeline: five stages over ``documents``, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``docs``.

  quality_rules   rejects documents that fail the base rules or the trees
  line_dedup      cuts lines found in five documents or more, but for one
  near_dedup      keeps one document of each group of near duplicates
  source_mixing   repeats or leaves out documents to meet target weights
  bpe             token ids of the whole text, and digests of both directions

``ORACLE_SQL`` is None: boosted trees and BPE have no SQL form; the tests hold
``run`` against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recspark.llm import bpe, linededup, mixing, quality, setsketch
from recspark.llm.common import materialize, table
from recspark.llm.queries import MIX_OTHER_WEIGHT, MIX_WEIGHTS, vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good_documents(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return setsketch.drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs, MIX_WEIGHTS, MIX_OTHER_WEIGHT)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = bpe.encode_documents(docs, bpe.load_vocabulary(vocabulary_path()))
    return ids.drop("text")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup),
          ("near_dedup", near_dedup), ("source_mixing", source_mixing), ("bpe", encode)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
