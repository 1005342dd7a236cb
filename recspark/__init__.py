"""recspark: recommendation analytics as Spark DataFrame / SQL / ML plans.

Sub-packages:
  sources    readers and writers (text, table, message parsing, sinks)
  functions  column expressions shared by all operators
  operators  batch operators: statistics, tags, top-k, similarity, content,
             factor models, splits, evaluation, re-ranking
  streaming  Structured Streaming recommender (state, foreachBatch, upsert)
  plans      named queries over the test tables and their SQL oracles
"""

__version__ = "0.1.0"
