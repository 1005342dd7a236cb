"""Operators of a large-scale training-data pipeline.

  quality     monotone gradient-boosted trees over document statistics
  setsketch   near-duplicate documents by SetSketch registers
  mixing      Poisson replication of documents to target source weights
  langid      hyperdimensional language profiles
  chat        budgeted chat windows with a reversible template
  lattice     near-duplicate vectors by E8 lattice hashing
  sharding    weighted rendezvous hashing with gapless slots
  bpe         byte-level BPE over a contiguous rank array
  pii         character BiLSTM-CRF next to fixed patterns
  linededup   line de-duplication by range-partitioned line hashes
  tokencount  token counts of whole texts by overlap resynchronisation
  negatives   hard negatives by segment summary filtering
  merkle      Merkle manifest with incremental witnesses

``queries`` holds the registered queries, ``oracle`` their DuckDB SQL.
Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package run in Python workers; ship them by value, so the
# workers need numpy and pyarrow only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
