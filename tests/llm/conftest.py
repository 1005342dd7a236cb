"""Small tables with the awkward cases every operator must stand."""

import random

import pytest
from pyspark.sql import types as T

# This module hides tests/conftest.py from those collected after it.
SF_SMALL = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # columns whose names clash with those that operators add or use inside
    T.StructField("kept", T.StringType()), T.StructField("copy", T.IntegerType()),
    T.StructField("shard", T.StringType()), T.StructField("digest", T.IntegerType()),
    T.StructField("n_words", T.StringType()), T.StructField("pos", T.StringType())])


def words(n, seed, pool=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(pool)}" for _ in range(n))


def edge_rows():
    long_line = "This very line is shared by many of the documents here."
    texts = ["", None, " \t\r\n", "one", "one two three four", words(60, 1), words(60, 1),
             words(60, 1) + " tail", words(300, 2), words(20_000, 3),
             "Ünïcödé \U0001F389 你好 " + words(30, 4), "\n\n\n",
             "mail a.b@c.example.com or 10.0.0.1 now", "x" * 30_000]
    texts += [f"{words(8, 50 + i)}\n  {long_line.upper() if i % 2 else long_line}\t\nend {i}"
              for i in range(7)]
    rows = [(i, t, "en" if i % 3 else None, ["hot", "src1", None][i % 3 if i % 4 else 0],
             len(t or ""), "k", 7, "s", 1, "n", "p") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5]]                                 # repeated rows
    rows += [(None, words(60, 9), "en", "hot", 1, "k", 7, "s", 1, "n", "p"),
             (None, None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
