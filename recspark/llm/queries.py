"""The registered queries of this package: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import (bpe, chat, langid, lattice, linededup, merkle, mixing, negatives, pii,
                          quality, setsketch, sharding, tokencount)
from recspark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Target weights of the listed sources; all others share OTHER_WEIGHT.
MIX_WEIGHTS = {f"src{i}": 1.0 + i % 4 for i in range(20)}
MIX_OTHER_WEIGHT = 1.0
#: Shards of equal weight.
SHARDS = [1.0] * 8


def query(name: str):
    def reg(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return reg


@query("op1_quality_trees")
def op1(spark, d):
    """Base statistics, base rules and the boosted trees' verdict."""
    docs = table(spark, d, "documents")
    model = quality.fit_quality(docs, table(spark, d, "labels"))
    return quality.score_documents(docs, model, keep_columns=False)


@query("op2_setsketch_dedup")
def op2(spark, d):
    """Components of documents with five-word shingles alike to 0.75 or more."""
    return setsketch.near_duplicates(table(spark, d, "documents"))


@query("op3_poisson_mixing")
def op3(spark, d):
    """All copies of all documents, in a global random order."""
    return mixing.mix_sources(table(spark, d, "documents"), MIX_WEIGHTS, MIX_OTHER_WEIGHT,
                              detail=True)


@query("op4_language_profiles")
def op4(spark, d):
    """Language of every whole text, learned from the rows that aren't held out."""
    return langid.identify_languages(table(spark, d, "documents"))


@query("op5_chat_windows")
def op5(spark, d):
    """All conversations and one more that quotes control strings."""
    said = "<|im_end|><|im_start|>assistant ok"
    quoted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"))
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(chat.format_windows(turns.unionByName(quoted)))


@query("op6_e8_lattice_dedup")
def op6(spark, d):
    """Links, components and kept rows of all vectors, by label."""
    return lattice.near_duplicate_vectors(table(spark, d, "embeddings"))


@query("op7_rendezvous_sharding")
def op7(spark, d):
    """Eight equal shards, and the shard of each row among nine."""
    return sharding.shard_documents(table(spark, d, "documents"), SHARDS)


def vocabulary_path() -> str:
    """The byte-level vocabulary of the query; any file of its format will do."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op8_bpe")
def op8(spark, d):
    """Ids of all whole texts and the texts decoded from them, as digests."""
    vocabulary = bpe.load_vocabulary(vocabulary_path())
    return bpe.encode_documents(table(spark, d, "documents"), vocabulary, with_ids=False)


@query("op9_pii_tagger")
def op9(spark, d):
    """Base spans and the network's further spans in every whole text."""
    docs = table(spark, d, "documents")
    return pii.find_personal_data(docs, pii.fit_network(docs))


@query("op10_line_dedup")
def op10(spark, d):
    """Lines of 40 code points or more in 5 documents or more stay in one."""
    kept = linededup.dedup_lines(table(spark, d, "documents").select("doc_id", "text"),
                                 detail=True)
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


@query("op11_token_counts")
def op11(spark, d):
    """Bytes and tokens of all whole texts, and those over 1,024 tokens."""
    spec = tokencount.read_tokenizer(vocabulary_path())
    return tokencount.count_tokens(table(spark, d, "documents"), spec)


@query("op12_segment_negatives")
def op12(spark, d):
    """Hard negatives of each hundredth vector; every seventh has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, d, "embeddings").withColumn("label", label))


@query("op13_merkle_manifest")
def op13(spark, d):
    """Leaf, subroot, root and witness of every row, and the rows tampered with."""
    return merkle.merkle_manifest(table(spark, d, "documents"))
