"""The pipeline against its stages by brute force, and the queries' oracles."""

import hashlib
import os
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from recspark.llm import bpe, mixing, quality
from recspark.llm.oracle import ORACLES
from recspark.llm.queries import MIX_OTHER_WEIGHT, MIX_WEIGHTS, QUERIES, vocabulary_path
from test_llm_native import brute_copies, brute_lines
from test_llm_text import brute_base, brute_components
from tools.check_oracle import TABLES, _rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "source_mixing", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_brute_force(spark, documents):
    """Every stage by plain Python; the trees' verdict is taken from the model."""
    model = quality.fit_quality(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    verdict = {r["doc_id"]: r["quality"] for r in
               quality.score_documents(documents, model, keep_columns=False).collect()}
    docs = []
    for r in documents.collect():
        b = brute_base(r["text"])
        if b[0] >= 50 and 100 * b[4] <= 50 * b[0] and verdict[r["doc_id"]] >= 0.5:
            docs.append(r.asDict())
    assert 0 < len(docs) < documents.count()
    text = {k[0]: k[3] for k in brute_lines(docs)}
    docs = [{**d, "text": text[d["doc_id"]]} for d in docs]
    parts = brute_components([(d["doc_id"], d["text"]) for d in docs])
    docs = [d for d in docs if parts[d["doc_id"]][1] == d["doc_id"]]
    copies = brute_copies(docs, MIX_WEIGHTS, MIX_OTHER_WEIGHT, 1.0)
    tokenizer = bpe.Tokenizer(bpe.load_vocabulary(vocabulary_path()))
    want = Counter()
    for (doc_id, body, _, _), n in copies.items():
        ids = next(iter(tokenizer.encode([body]))).tolist()
        assert tokenizer.decode(ids) == body
        want[doc_id, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(body.encode()).hexdigest()] += n
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want


def test_stages_on_awkward_rows(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name == "bpe":
                assert out.count() == docs.count()
            else:
                assert out.columns == docs.columns
                out.count()


def test_mixing_stage_keeps_clashing_columns(edge_docs):
    got = mixing.mix_sources(edge_docs, {"hot": 1.0}, epochs=3.0)
    assert {r["copy"] for r in got.collect()} <= {7, None}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert _rows(QUERIES[name](spark, SF).toPandas()) == _rows(con.execute(ORACLES[name]).df())


def test_one_query_per_operator():
    numbers = sorted(int(q[2:].split("_")[0]) for q in QUERIES)
    assert numbers == list(range(1, 14))


def test_op5_digests(spark):
    from test_llm_native import digests
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    said = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = QUERIES["op5_chat_windows"](spark, SF)
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
            for r in got.collect()} == digests(rows)
    assert got.where(F.col("formatted_chars") <= F.col("loss_chars")).count() == 0
