"""Hard negatives by segment summary filtering.

A vector's components become integers, floor(scale * x), and a score is the
integer inner product.  Anchors look for their positives, the best rows of their
label, and for each positive for the best rows of other labels whose score lies
between ``LOW`` and 100 percent of the positive's.

Segments.  A vector is cut into segments of neighbouring components, on each level
of ``LEVELS`` into more of them.  A segment stores its mean and its deviation from
it (as a length), so the segment's part of an inner product is the means' product
times the segment's length, plus or minus at most the product of the deviations.
The sum over the coarsest segments bounds every score of a block in one product of
short vectors; pairs that can still reach an anchor's list are bounded again on
finer segments, and what is left is scored exactly.  A list's bar is its band's
lower end, or its k-th best score in the block so far, whichever is higher, so
nothing is left out that could be in the result.

Blocks.  Rows are dealt by hash to blocks, per label for the positives, so a label
with any share of the rows is divided; anchors are dealt to packs.  Each pack meets
each block in one group that streams the block past the pack and returns at most k
rows per list.  Vectors of different lengths never meet.

Defined results: rows with a null id, label or vector, an empty vector, or a null
or non-finite component take no part; rows that repeat an id are rows of their own
(a copy of an anchor's row is an other row of its label), equal scores and ids
stand in any order; components and scores beyond +-2**62 are held there; a positive
score below zero has no negatives, as its band is empty; an anchor without
positives gives no rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.common import materialize

SCALE = 256
#: Segments of a vector, from coarse to fine.
LEVELS = (4, 16)
POSITIVES = 5
NEGATIVES = 5
#: Percent of the positive's score that a negative must reach.
LOW = 80
#: Anchors of a pack, and bounds of the rows of a block, which follow the rows.
PACK = 2048
BLOCK = (1024, 65_536)
#: Rows bounded and scored at once.
STEP = 512
#: From one pair in so many on, a product of all rows costs less than their pairs.
DENSE = 20

_LIMIT = 2.0 ** 62
#: Beyond every score.
_BEYOND = 2 ** 62 + 1
#: Share of both lengths that rounding of the stored summaries may take.
_SLACK = 1e-6


def quantize(x: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """floor(scale * x) as whole doubles."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x.astype(np.float64) * scale), -_LIMIT, _LIMIT)


def summarise(q: np.ndarray, segments: int) -> np.ndarray:
    """(rows, 2, segments): mean times root of length, and deviation."""
    n, dim = q.shape
    cuts = np.unique(np.arange(segments) * dim // segments)
    length = np.diff(np.append(cuts, dim))
    mean = np.add.reduceat(q, cuts, axis=1) / length
    rest = q - np.repeat(mean, length, axis=1)
    out = np.zeros((n, 2, segments))
    out[:, 0, :len(cuts)] = mean * np.sqrt(length)
    out[:, 1, :len(cuts)] = np.sqrt(np.add.reduceat(rest ** 2, cuts, axis=1))
    return out


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores of summaries (rows, 2, segments)."""
    mid, dev = a[:, 0] @ b[:, 0].T, a[:, 1] @ b[:, 1].T
    slack = _SLACK * np.sqrt(np.outer((a ** 2).sum((1, 2)), (b ** 2).sum((1, 2))))
    return mid - dev - slack, mid + dev + slack


def pair_bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for pairs of summaries, row by row."""
    mid, dev = (a[:, 0] * b[:, 0]).sum(1), (a[:, 1] * b[:, 1]).sum(1)
    slack = _SLACK * np.sqrt((a ** 2).sum((1, 2)) * (b ** 2).sum((1, 2)))
    return mid - dev - slack, mid + dev + slack


def exact_scores(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs (i, j)."""
    top = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if top >= 2.0 ** 53:                       # beyond what doubles add exactly
        out = [sum(int(x) * int(y) for x, y in zip(a[p], b[q])) for p, q in zip(i, j)]
        return np.array([max(-2 ** 62, min(2 ** 62, s)) for s in out], np.int64)
    if len(i) * DENSE >= len(a) * len(b):      # a dense product costs less
        return np.rint((a @ b.T)[i, j]).astype(np.int64)
    parts = [np.zeros(0)]
    for at in range(0, len(i), 1 << 16):
        s = slice(at, at + (1 << 16))
        parts.append(np.einsum("ij,ij->i", a[i[s]], b[j[s]]))
    return np.rint(np.concatenate(parts)).astype(np.int64)


class Pack:
    """Anchors and their lists; rows stream past.

    ``low`` and ``high`` (anchors, lists) are the lists' bands; an empty band
    takes nothing.  ``other`` says that only rows of other labels count, otherwise
    only those of the same label.
    """

    def __init__(self, anchors: dict, low: np.ndarray, high: np.ndarray, k: int, other: bool):
        self.a, self.low, self.high, self.k, self.other = anchors, low, high, k, other
        self.levels = [summarise(anchors["q"], s) for s in LEVELS]
        n, self.lists = low.shape
        self.kth = np.full(low.shape, -_BEYOND)
        self.best = {c: np.zeros(0, np.int64) for c in ("list", "score", "id", "row")}
        self.n = n
        self.scored = 0                        # exact scores so far

    def add(self, rows: dict) -> None:
        a, b = self.a, rows
        bar = np.where(self.low <= self.high, np.maximum(self.low, self.kth), _BEYOND).min(1)
        roof = np.where(self.low <= self.high, self.high, -_BEYOND).max(1)
        same = a["label"][:, None] == b["label"]
        ok = ~same if self.other else same
        ok &= a["row"][:, None] != b["row"]
        low, up = bounds(self.levels[0], b["levels"][0])
        i, j = np.nonzero(ok & (up >= bar[:, None]) & (low <= roof[:, None]))
        for mine, theirs in zip(self.levels[1:], b["levels"][1:]):
            if len(i) * DENSE >= len(mine) * len(theirs):
                low, up = bounds(mine, theirs)
                keep = (up[i, j] >= bar[i]) & (low[i, j] <= roof[i])
                i, j = i[keep], j[keep]
                continue
            keep = []
            for at in range(0, len(i), 1 << 16):
                s = slice(at, at + (1 << 16))
                low, up = pair_bounds(mine[i[s]], theirs[j[s]])
                keep.append((up >= bar[i[s]]) & (low <= roof[i[s]]))
            if keep:
                keep = np.concatenate(keep)
                i, j = i[keep], j[keep]
        if not len(i):
            return
        score = exact_scores(a["q"], b["q"], i, j)
        self.scored += len(i)
        pair, which = np.nonzero((score[:, None] >= self.low[i]) & (score[:, None] <= self.high[i])
                                 & (score[:, None] >= self.kth[i]))
        new = {"list": i[pair] * self.lists + which, "score": score[pair],
               "id": b["id"][j[pair]], "row": b["row"][j[pair]]}
        self._cut({c: np.concatenate([self.best[c], new[c]]) for c in new})

    def _cut(self, all_: dict) -> None:
        """The first k of each list: higher scores, smaller ids."""
        order = np.lexsort((all_["row"], all_["id"], -all_["score"], all_["list"]))
        lists = all_["list"][order]
        first = np.searchsorted(lists, lists)
        place = np.arange(len(lists)) - first
        self.best = {c: v[order][place < self.k] for c, v in all_.items()}
        full = order[place == self.k - 1]
        kth = self.kth.ravel()
        kth[all_["list"][full]] = all_["score"][full]
        self.kth = kth.reshape(self.low.shape)

    def result(self) -> pa.RecordBatch:
        b = self.best
        return pa.RecordBatch.from_arrays(
            [pa.array(self.a["row"][b["list"] // self.lists]),
             pa.array(b["list"] % self.lists), pa.array(b["score"]), pa.array(b["id"]),
             pa.array(b["row"])], ["anchor", "list", "score", "id", "row"])


_RESULT = "anchor long, list long, score long, id long, row long"


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """Whole doubles from vectors packed as int16, or as doubles where longer."""
    cells = column.to_pylist()
    out = np.empty((len(cells), dim))
    wide = np.array([len(c) == 8 * dim for c in cells])
    for kind, rows in ((np.float64, np.flatnonzero(wide)), (np.int16, np.flatnonzero(~wide))):
        if len(rows):
            out[rows] = np.frombuffer(b"".join(cells[r] for r in rows), kind).reshape(-1, dim)
    return out


def _decode(part: pa.RecordBatch) -> dict:
    dim = part.column("dim")[0].as_py()
    out = {c: part.column(f).to_numpy(zero_copy_only=False) for c, f in (
        ("row", "row"), ("id", "vec_id"), ("label", "label"))}
    out["q"] = _vectors(part.column("q"), dim)
    stored = np.frombuffer(b"".join(part.column("summary").to_pylist()), np.float32).astype(
        np.float64).reshape(part.num_rows, -1)
    cuts = np.cumsum([0, *(2 * s for s in LEVELS)])
    out["levels"] = [stored[:, x:y].reshape(part.num_rows, 2, -1)
                     for x, y in zip(cuts[:-1], cuts[1:])]
    return out


def _prepare_batches(scale: float):
    """Packs vectors as bytes and stores their segments' summaries."""
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                x = b.column("embedding")
                dims = x.value_lengths().to_numpy(zero_copy_only=False)
                for dim in np.unique(dims):
                    rows = pa.array(np.flatnonzero(dims == dim))
                    part = b.take(rows)
                    q = quantize(part.column("embedding").flatten().to_numpy(
                        zero_copy_only=False).reshape(-1, dim), scale)
                    small = np.abs(q).max(axis=1) < 2 ** 15 if len(q) else np.zeros(0, bool)
                    cells = [(v.astype(np.int16) if s else v).tobytes() for v, s in zip(q, small)]
                    summary = np.concatenate(
                        [summarise(q, s).reshape(len(q), -1) for s in LEVELS], 1).astype(np.float32)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id"), part.column("label"),
                         pa.array(np.full(len(q), dim, np.int32)), pa.array(cells, pa.binary()),
                         pa.array([s.tobytes() for s in summary], pa.binary())],
                        ["vec_id", "label", "dim", "q", "summary"])
    return prepare


def _meet_batches(keys: list[str], k: int, other: bool):
    """Streams blocks of rows past packs of anchors.  Sorted by ``keys`` and kind:
    the anchors (kind 0) come before the rows (kind 1) of a group."""
    names = [*keys, "kind"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices of one group and kind, of at most STEP rows."""
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                b = whole.slice(at, STEP)
                new = np.zeros(b.num_rows, bool)
                for c in names:
                    v = b.column(c).to_numpy(zero_copy_only=False)
                    new[1:] |= v[1:] != v[:-1]
                cuts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
                for s, e in zip(cuts[:-1], cuts[1:]):
                    yield b.slice(s, e - s)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, anchors, pack = None, [], None
        for part in runs(batches):
            key = tuple(part.column(c)[0].as_py() for c in keys)
            if key != group:
                if pack is not None:
                    yield pack.result()
                group, anchors, pack = key, [], None
            if part.column("kind")[0].as_py() == 0:
                anchors.append(part)
            elif anchors:
                if pack is None:
                    pack = _pack(anchors, k, other)
                pack.add(_decode(part))
        if pack is not None:
            yield pack.result()
    return meet


def _pack(parts: list[pa.RecordBatch], k: int, other: bool) -> Pack:
    both = [_decode(p) for p in parts]
    anchors = {c: np.concatenate([b[c] for b in both]) for c in ("row", "id", "label", "q")}
    bars = [x for p in parts for x in p.column("bars").to_pylist()]
    lists = max([1, *(len(x or []) for x in bars)])
    low, high = (np.full((len(bars), lists), x) for x in (_BEYOND, -_BEYOND))
    for r, row in enumerate(bars):
        if row is None:                        # one list without a band
            low[r, 0], high[r, 0] = -_BEYOND, _BEYOND
        for c, band in enumerate(row or []):
            low[r, c], high[r, c] = band["low"], band["high"]
    return Pack(anchors, low, high, k, other)


def _fit(e: Column) -> Column:
    return (e.isNotNull() & (F.size(e) > 0)
            & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))


def prepare_vectors(df: DataFrame, is_anchor: Column, scale: float = SCALE) -> DataFrame:
    """row (a key), vec_id, label, dim, q, summary and anchor of the rows of ``df``
    that take part."""
    e = F.col("embedding")
    rows = (df.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _fit(e))
            .select(F.col("vec_id").cast("long"), F.col("label").cast("long"), e))
    packed = rows.mapInArrow(_prepare_batches(scale), "vec_id long, label long, dim int, "
                             "q binary, summary binary")
    return materialize(packed.select(F.monotonically_increasing_id().alias("row"), "*",
                                     is_anchor.alias("anchor")), "prepared")


def _parts(size: Column, rows: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(size / F.lit(rows))).cast("int")


def _deal(side: DataFrame, kind: int, own: str, n_own: Column, other: str, n_other: Column
          ) -> DataFrame:
    """Each row once for every part of the other side."""
    return (side.withColumn(own, F.pmod(F.xxhash64("row"), n_own).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), n_other - 1)))
            .withColumn("kind", F.lit(kind)))


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor", "list").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


_BARS = "array<struct<low:bigint,high:bigint>>"


def _search(rows: DataFrame, anchors: DataFrame, keys: list[str], sizes: DataFrame, k: int,
            other: bool, name: str) -> DataFrame:
    """The k best of each list (anchor, list, score, id, row, place).  ``keys`` must
    be equal; ``sizes`` has (keys, packs, parts)."""
    columns = ["row", "vec_id", "label", "dim", "q", "summary"]
    group = [*keys, "pack", "part"]
    left = _deal(anchors.join(sizes, keys), 0, "pack", F.col("packs"), "part", F.col("parts"))
    right = _deal(rows.join(sizes, keys), 1, "part", F.col("parts"), "pack", F.col("packs"))
    both = left.select(*columns, "bars", "pack", "part", "kind").unionByName(
        right.select(*columns, F.lit(None).cast(_BARS).alias("bars"), "pack", "part", "kind"))
    met = (both.repartition(*group).sortWithinPartitions(*group, "kind")
           .mapInArrow(_meet_batches(group, k, other), _RESULT))
    return materialize(_best(met, k), name)


def hard_negatives(df: DataFrame, is_anchor: Column | None = None, scale: float = SCALE,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW
                   ) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score
    for the anchors of ``df`` (vec_id, label, embedding); ``is_anchor`` is a condition
    on vec_id, by default that 100 divides it."""
    anchor = F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor
    rows = prepare_vectors(df, anchor, scale)
    total = rows.count()
    # Blocks follow the rows: enough of them for small tables, few copies for large ones.
    block = min(BLOCK[1], max(BLOCK[0], total // 64))
    anchors = rows.where("anchor").withColumn("bars", F.lit(None).cast(_BARS))

    def sizes(*keys: str) -> DataFrame:
        n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    F.count_if("anchor").alias("a")).where("a > 0")
        return n.select(*keys, _parts(F.col("a"), PACK).alias("packs"),
                        _parts(F.col("n"), block).alias("parts"))

    best = _search(rows, anchors, ["dim", "label"], sizes("dim", "label"), positives, False,
                   "positives")
    # Whole numbers at or above low percent of the score, without rounding.
    lowest = F.ceil(F.col("score").cast("decimal(20,0)") * F.lit(low) / F.lit(100)).cast("long")
    bars = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct(
        "place", lowest.alias("low"), F.col("score").alias("high")))).alias("b"))
    bars = bars.select(F.col("anchor").alias("row"), F.transform(
        "b", lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high"))).alias("bars"))
    with_bars = rows.where("anchor").join(bars, "row")
    worst = _search(rows, with_bars, ["dim"], sizes("dim"), negatives, True, "negatives")
    found = worst.select("anchor", (F.col("list") + 1).cast("int").alias("place"),
                         F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
    owners = rows.where("anchor").select(F.col("row").alias("anchor"),
                                         F.col("vec_id").alias("anchor_id"))
    return (found.join(best.select("anchor", "place", F.col("id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["anchor", "place"])
            .join(owners, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
