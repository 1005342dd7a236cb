"""Token counts of whole texts by overlap resynchronisation.

A byte-level BPE vocabulary cuts a text into words by a pattern and merges inside
words only.  So a text can be counted in parts, if the parts meet where the cut of
the whole text has a word's start.  Texts up to ``LONG`` characters are counted
where they are read.  A longer one is cut every ``PIECE`` characters, and each
piece, with ``OVERLAP`` characters of the next one, is a row that any task may
encode, from its own first character on.

Splicing.  A piece returns the word starts inside its two overlaps, each with the
number of its tokens before it.  Two neighbours are spliced at the first position
where both have a word start.  The start is proven: the left cut is right from
its own splice on, so it equals the whole text's there, unless it looked past its
end, for which the last ``MARGIN`` characters do not count (a special token's
string or a contraction that the end cuts off).  And the pattern looks ahead only,
so two cuts that share a word start are equal from there on.  The tokens between
two splices of a piece are then the whole text's.

Widening.  Where no position is common (a run of letters longer than the overlap)
the left piece takes over its whole neighbour, later two, four, eight, so its
overlap with the text behind is that much wider; it is encoded again and spliced
with what follows, until all neighbours meet or one piece is left.

A task counts each distinct chunk between white space once, by the tokenizers
library, in a cache bounded in characters.  Copies of a long text are encoded
once.

Defined results: a null text is the empty one and has no tokens; special tokens'
strings inside a text are found first and count as one token; rows that repeat are
counted each; an empty table gives no rows; other columns are ignored.  Memory of
a task follows ``PIECE``, or the longest single word, and the longest row, which
is held once while it is cut.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.bpe import PATTERN, WHITE
from recspark.llm.common import materialize, text_chunks

#: Tokens beyond which a text is over the limit.
LIMIT = 1024
#: Characters up to which a text is counted whole, of a piece, and of an overlap.
LONG = 65_536
PIECE = 32_768
OVERLAP = 1_024
#: Characters of distinct chunks that a task keeps.
CACHE_CHARS = 24 << 20
#: Longer chunks are counted each time they come.
CACHED_CHUNK = 512


def read_tokenizer(path: str) -> str:
    """The text of a tokenizers file, checked for what the method relies on."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    pre = spec.get("pre_tokenizer") or {}
    if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
            or pre.get("add_prefix_space")):
        raise ValueError("the file must cut words by the byte-level pattern alone")
    for t in spec.get("added_tokens", []):
        if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized"):
            raise ValueError(f"the added token {t['content']!r} looks at its neighbours")
    return text


class Counter:
    """Counts the tokens of texts; keeps the counts of chunks it has met."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # a task has one core
        from tokenizers import Tokenizer
        self._t = Tokenizer.from_str(spec)
        self._t.no_truncation()
        self._t.no_padding()
        names = sorted((t["content"] for t in json.loads(spec).get("added_tokens", [])),
                       key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, names))) if names else None
        self._names = frozenset(names)
        #: Word starts so close to a cut-off end may be wrong.
        self.margin = max([3, *map(len, names)]) + 3
        # White space always ends a word, so a chunk's cut is the whole text's.
        self._chunks = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        self._words = regex.compile(PATTERN.replace(r"\S", f"[^{WHITE}]").replace(
            r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]"))
        self._cache: dict[str, int] = {}
        self._held = 0

    def _split(self, text: str, cut) -> list[str]:
        """The parts of a text by ``cut``, special tokens between them."""
        if self._special is None or not self._special.search(text):
            return cut(text)
        out, at = [], 0
        for m in self._special.finditer(text):
            out += cut(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + cut(text[at:])

    def _learn(self, parts: set[str]) -> dict[str, int]:
        """The counts of parts: the cache, which has them now, and the counts that
        it doesn't keep."""
        cache = self._cache
        if self._held > CACHE_CHARS:
            cache.clear()
            self._held = 0
        new = [p for p in parts if p not in cache]
        count = [len(e) for e in self._t.encode_batch_fast(new, add_special_tokens=False)]
        extra = {}
        for p, n in zip(new, count):
            if len(p) <= CACHED_CHUNK:
                cache[p] = n
                self._held += len(p) + 64
            else:
                extra[p] = n
        return _Both(cache, extra) if extra else cache

    def count(self, texts: list[str]) -> list[int]:
        split = [self._split(t, self._chunks.findall) for t in texts]
        known = self._learn(set().union(*split)).__getitem__
        return [sum(map(known, parts)) for parts in split]

    def boundaries(self, text: str, head: int, tail: int
                   ) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]]]:
        """The tokens of ``text``, and (position, tokens before it) of the word
        starts before ``head`` and of those from ``tail`` on."""
        parts = self._split(text, self._chunks.findall)
        starts = [0, *accumulate(map(len, parts))]
        fine: list[str] = []                    # words near the ends, chunks between them
        for part, start in zip(parts, starts):
            near = start < head or start + len(part) > tail
            fine += self._words.findall(part) if near and part not in self._names else [part]
        known = self._learn(set(fine)).__getitem__
        places = [0, *accumulate(map(len, fine))]
        before = [0, *accumulate(map(known, fine))]
        each = list(zip(places[:-1], before[:-1]))
        return (before[-1], [x for x in each if x[0] < head], [x for x in each if x[0] >= tail])


class _Both(dict):
    """The cache, and for one call the counts that it doesn't keep."""

    def __init__(self, cache: dict[str, int], extra: dict[str, int]):
        super().__init__(extra)
        self._cache = cache

    def __missing__(self, key: str) -> int:
        return self._cache[key]


def _count_batches(spec: str, long: int, piece: int, overlap: int):
    """A row per text, with its count or the key of its pieces; a row per piece."""
    names = ["doc_id", "n_bytes", "n_tokens", "key", "piece", "last", "text"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string()]

    def rows(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(spec)
        seen: set[str] = set()
        for whole in batches:
            for batch in text_chunks(whole):
                n = batch.num_rows
                texts = [t or "" for t in batch.column("text").to_pylist()]
                short = [i for i, t in enumerate(texts) if len(t) <= long]
                tokens: list[int | None] = [None] * n
                for i, c in zip(short, counter.count([texts[i] for i in short])):
                    tokens[i] = c
                keys = [None if c is not None else
                        hashlib.blake2b(t.encode(), digest_size=16).hexdigest()
                        for c, t in zip(tokens, texts)]
                size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
                none = [None] * n
                yield rows([batch.column("doc_id").to_pylist(), size, tokens, keys, none, none,
                            none])
                for key, text in zip(keys, texts):
                    if key is None or key in seen:
                        continue
                    seen.add(key)
                    # The last piece also has what is left, so none is tiny.
                    pieces = max(1, len(text) // piece)
                    for k in range(pieces):
                        last = k == pieces - 1
                        part = text[k * piece:None if last else (k + 1) * piece + overlap]
                        yield rows([[None], [None], [None], [key], [k], [last], [part]])
    return count


_COUNTED = ("key string, piece long, upto long, last boolean, total long, "
            "head array<struct<at:long,n:long>>, tail array<struct<at:long,n:long>>")


def _boundary_batches(spec: str, piece: int, overlap: int):
    """Encodes pieces (key, piece, upto, last, text): piece is the first of those
    that the text covers, upto the one behind the last."""
    marks = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(spec)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                text = row.column("text")[0].as_py()
                first, upto = (row.column(c)[0].as_py() for c in ("piece", "upto"))
                last = row.column("last")[0].as_py()
                start, end = first * piece, len(text)
                tail = end + 1 if last else (upto - first) * piece
                total, heads, tails = counter.boundaries(text, overlap if first else 0, tail)
                if last:
                    tails = []
                shown = [[{"at": start + at, "n": n} for at, n in some] for some in (
                    heads, [x for x in tails if x[0] + counter.margin <= end])]
                yield pa.RecordBatch.from_arrays(
                    [row.column("key"), row.column("piece"), row.column("upto"),
                     row.column("last"), pa.array([total], pa.int64()),
                     *(pa.array([s], marks) for s in shown)],
                    ["key", "piece", "upto", "last", "total", "head", "tail"])
    return encode


def _joints(counted: DataFrame) -> DataFrame:
    """(key, piece, spliced) for every piece but the first of a text: the tokens
    to the left of the splice, less those of this piece; null without a splice."""
    left = (counted.where("not last")
            .select("key", F.col("upto").alias("piece"), F.explode("tail").alias("m"))
            .select("key", "piece", "m.at", F.col("m.n").alias("n_left")))
    right = (counted.where("piece > 0").select("key", "piece", F.explode("head").alias("m"))
             .select("key", "piece", "m.at", F.col("m.n").alias("n_right")))
    common = (left.join(right, ["key", "piece", "at"]).groupBy("key", "piece")
              .agg(F.min_by(F.col("n_left") - F.col("n_right"), "at").alias("spliced")))
    return counted.where("piece > 0").select("key", "piece").join(
        common, ["key", "piece"], "left")


def _widened(counted: DataFrame, joints: DataFrame, reach: int) -> DataFrame:
    """(key, old, piece, upto, last): the pieces of texts with a joint that isn't
    spliced; the piece on its left takes over ``reach`` pieces on its right."""
    w = Window.partitionBy("key").orderBy("piece")
    rows = counted.select("key", "piece", "upto", "last").join(
        joints.select("key", "piece", F.col("spliced").isNull().alias("apart")),
        ["key", "piece"], "left")
    # One small row per piece; a row of Spark holds fewer than 2 GB of text.
    taken = rows.withColumn("taken", F.max(F.coalesce("apart", F.lit(False))).over(
        w.rowsBetween(1 - reach, 0)))
    return (taken.withColumn("new", F.last(F.when(~F.col("taken"), F.col("piece")), True).over(w))
            .select("key", F.col("piece").alias("old"), F.col("new").alias("piece"), "upto",
                    "last"))


def count_tokens(docs: DataFrame, spec: str, limit: int = LIMIT, long: int = LONG,
                 piece: int = PIECE, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``.

    ``spec`` is the text of a tokenizers file (``read_tokenizer``); it goes to the
    tasks with their function, so executors need not have the file.
    """
    if not 0 < overlap <= piece <= long:
        raise ValueError("0 < overlap <= piece <= long must hold")
    first = materialize(docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(
        _count_batches(spec, long, piece, overlap),
        "doc_id long, n_bytes long, n_tokens long, key string, piece long, last boolean, "
        "text string"), "counts")
    texts = first.where("piece is null").select("doc_id", "n_bytes", "n_tokens", "key")
    encode = _boundary_batches(spec, piece, overlap)
    pieces = materialize(
        first.where("piece is not null").repartition("key", "piece")
        .dropDuplicates(["key", "piece"])
        .select("key", "piece", (F.col("piece") + 1).alias("upto"), "last", "text"), "pieces")
    counted = materialize(pieces.mapInArrow(encode, _COUNTED), "encoded")
    reach = 1
    while True:
        joints = materialize(_joints(counted), "joints")
        apart = joints.where("spliced is null").select("key").distinct()
        if apart.limit(1).count() == 0:
            break
        touched = counted.join(apart, "key", "left_semi")
        plan = materialize(_widened(touched, joints, reach), "widened")
        grown = (plan.groupBy("key", "piece").agg(
            F.max("upto").alias("upto"), F.max("last").alias("last"),
            F.count(F.lit(1)).alias("held")).where("held > 1"))
        # The text of a grown piece: its pieces without their overlaps, but the last one's.
        p = pieces.select("key", F.col("piece").alias("k"), "text")
        g = grown.select("key", F.col("piece").alias("from"), "upto", "last")
        members = (g.withColumn("k", F.explode(F.sequence(F.col("from"), F.col("upto") - 1)))
                   .join(p, ["key", "k"]))
        part = F.when(F.col("k") < F.col("upto") - 1, F.substring("text", 1, piece)).otherwise(
            F.col("text"))
        joined = (members.groupBy("key", "from", "upto", "last")
                  .agg(F.array_sort(F.collect_list(F.struct("k", part.alias("text")))).alias("t"))
                  .select("key", F.col("from").alias("piece"), "upto", "last",
                          F.array_join("t.text", "").alias("text")))
        again = joined.mapInArrow(encode, _COUNTED)
        gone = plan.where("old <> piece").select("key", F.col("old").alias("piece")).union(
            grown.select("key", "piece"))
        counted = materialize(
            counted.join(gone, ["key", "piece"], "left_anti").unionByName(again), "encoded")
        reach *= 2
    totals = (counted.where("last").select("key", F.col("total").alias("n"))
              .union(joints.select("key", "spliced")).groupBy("key").agg(F.sum("n").alias("sum")))
    return (texts.join(totals, "key", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_tokens", "sum").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
