"""Quality rules: fixed base rules and monotone gradient-boosted trees.

Statistics of every whole text are computed from its bytes, words, lines and
three-word windows.  A model of boosted regression trees on the logistic loss is
fitted in numpy on a bounded sample of labelled documents (``TRAIN_DOCS``: the
labelled ids with the smallest hashes) and flattened into node arrays; scoring
walks all rows of a batch through a tree level by level.

Monotone constraints: on features where more is never better (repeats, repeated
lines, symbols, capitals) the score may not rise.  A split that breaks the order
is not made, and each child's values are held on its side of the middle of the
two, so the order holds for the whole tree and the whole model.

Defined results: a null text has no words and fails the base rules; labels
without a quality are not used, several labels of a document count by their
lowest; without labels of both kinds the model keeps what the base rules keep;
rows with a null id are scored like others; equal rows get equal scores; an
empty table gives no rows; added columns replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import text_chunks
from recspark.llm.text_arrays import Texts, mix

#: Bound of the training sample.
TRAIN_DOCS = 6000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A document is kept from this estimated probability of good quality.
THRESHOLD = 0.5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features and the direction the score may move with them (0: any).
FEATURES = {"log_words": 0, "word_length": 0, "symbol_rate": -1, "dup_line_rate": -1,
            "repeat_rate": -1, "capital_rate": -1, "digit_rate": 0, "mark_rate": 0,
            "line_words": 0, "distinct_words": 0, "distinct_windows": 0, "space_rate": 0,
            "other_rate": 0}

_U = np.uint64


def _marks(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[np.frombuffer(chars, np.uint8)] = True
    return t


_SYMBOL = _marks(b"#*$%&|<>")
_CAPITAL = _marks(bytes(range(65, 91)))
_DIGIT = _marks(bytes(range(48, 58)))
_MARK = _marks(b".,;:!?\"'()-")
_ASCII_OTHER = _marks(bytes(set(range(33, 127)) - set(b"#*$%&|<>.,;:!?\"'()-")
                            - set(range(48, 58)) - set(range(65, 91)) - set(range(97, 123))))


def _later_equal(key: np.ndarray) -> np.ndarray:
    """Marks all but the first of equal keys."""
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[order[1:]] = key[order[1:]] == key[order[:-1]]
    return same


def _in_group(key: np.ndarray) -> np.ndarray:
    """Marks keys that occur more than once."""
    order = np.argsort(key)
    s = key[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(key), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base statistics and the feature matrix of a column of texts."""
    t = Texts(column)
    n, b = t.n, t.bytes
    salt = mix(np.arange(n, dtype=_U) + _U(17))

    def rows(doc: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=n).astype(np.int64)

    points = t.per_doc((b & 0xC0) != 0x80)
    inside = np.zeros(len(b) + 1, np.int32)
    np.cumsum((b & 0xC0) != 0x80, out=inside[1:])
    word_chars = np.bincount(t.doc, weights=inside[t.ends] - inside[t.starts],
                             minlength=n).astype(np.int64)
    words = t.word_hashes()
    windows, at = t.windows(words, 3)
    keyed = mix(windows ^ salt[t.doc[at]])
    found = _in_group(keyed)
    repeat = np.zeros(len(words), bool)
    for j in range(3):
        repeat[at[found] + j] = True
    # Lines: cut at \n inside a text.
    breaks = np.flatnonzero(b == 10)
    line_start = np.concatenate([t.off[:-1], breaks + 1])
    line_doc = np.concatenate([np.arange(n), t.doc_of(breaks)])
    order = np.lexsort((line_start, line_doc))
    line_start, line_doc = line_start[order], line_doc[order]
    last = np.append(line_doc[1:] != line_doc[:-1], True) if len(line_doc) else np.zeros(0, bool)
    line_end = np.append(line_start[1:] - 1, 0) if len(line_doc) else line_start
    line_end[last] = t.off[line_doc[last] + 1]
    has_word = (np.searchsorted(t.starts, line_end) > np.searchsorted(t.starts, line_start))
    s, e, d = line_start[has_word], line_end[has_word], line_doc[has_word]
    dup = _later_equal(mix(t.span_hash(s, e) ^ salt[d]))
    base = {"n_words": t.n_words, "word_chars": word_chars,
            "n_symbols": t.per_doc(_SYMBOL[b]), "n_dup_lines": rows(d, dup),
            "n_repeat_words": rows(t.doc, repeat)}
    nw, nc = np.maximum(t.n_words, 1), np.maximum(points, 1)
    lines = np.maximum(np.bincount(d, minlength=n), 1)
    again = _later_equal(mix(words ^ salt[t.doc]))
    window_again = rows(t.doc[at], _later_equal(keyed))
    features = np.column_stack([
        np.log1p(t.n_words), word_chars / nw, base["n_symbols"] / nc, base["n_dup_lines"] / lines,
        base["n_repeat_words"] / nw, t.per_doc(_CAPITAL[b]) / nc, t.per_doc(_DIGIT[b]) / nc,
        t.per_doc(_MARK[b]) / nc, np.log1p(t.n_words / lines), 1 - rows(t.doc, again) / nw,
        1 - window_again / nw, (points - word_chars) / nc, t.per_doc(_ASCII_OTHER[b]) / nc])
    return base, features


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return ((base["n_words"] < MIN_WORDS)
            | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"]))


# --- boosted trees ---------------------------------------------------------------

@dataclass
class Trees:
    """Nodes of all trees, one tree after another; a leaf points to itself."""
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.cut[node],
                                self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 60,
              depth: int = 4, rate: float = 0.15, bins: int = 64, min_child: float = 5.0,
              ridge: float = 1.0) -> Trees:
    """Newton boosting over binned features with monotone directions."""
    n, m = x.shape
    rate_good = np.clip(y.mean() if n else 1.0, 1e-3, 1 - 1e-3)
    start = float(np.log(rate_good / (1 - rate_good)))
    nodes: list[list[float]] = []          # feature, cut, left, right, value
    roots: list[int] = []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else
            np.zeros(0) for f in range(m)]
    code = np.column_stack([np.searchsorted(cuts[f], x[:, f], side="left")
                            for f in range(m)]) if n else np.zeros((0, m), int)
    score = np.full(n, start)

    def leaf(value: float) -> int:
        k = len(nodes)
        nodes.append([0, 0.0, k, k, value])
        return k

    def best_split(rows, g, h, low, high):
        best = None
        for f in range(m):
            size = len(cuts[f]) + 1
            if size < 2:
                continue
            gs = np.cumsum(np.bincount(code[rows, f], g[rows], size))
            hs = np.cumsum(np.bincount(code[rows, f], h[rows], size))
            gl, hl = gs[:-1], hs[:-1]
            gr, hr = gs[-1] - gl, hs[-1] - hl
            vl = np.clip(-gl / (hl + ridge), low, high)
            vr = np.clip(-gr / (hr + ridge), low, high)
            gain = -(gl * vl + (hl + ridge) * vl ** 2 / 2 + gr * vr + (hr + ridge) * vr ** 2 / 2)
            ok = (hl >= min_child) & (hr >= min_child)
            if directions[f]:
                ok &= directions[f] * (vr - vl) >= 0
            gain = np.where(ok, gain, -np.inf)
            k = int(gain.argmax())
            if np.isfinite(gain[k]) and (best is None or gain[k] > best[0]):
                best = (gain[k], f, k, vl[k], vr[k])
        return best

    def grow(rows, g, h, level, low, high):
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
        here = -(g[rows].sum() * value + (h[rows].sum() + ridge) * value ** 2 / 2)
        best = best_split(rows, g, h, low, high) if level < depth else None
        if best is None or best[0] <= here + 1e-6:
            score[rows] += rate * value
            return leaf(rate * value)
        _, f, k, vl, vr = best
        node = leaf(0.0)
        goes = code[rows, f] <= k
        limits = ((low, high), (low, high))
        if directions[f]:                  # both sides stay apart at the middle
            mid = (vl + vr) / 2
            limits = (((low, mid), (mid, high)) if directions[f] > 0
                      else ((mid, high), (low, mid)))
        left = grow(rows[goes], g, h, level + 1, *limits[0])
        right = grow(rows[~goes], g, h, level + 1, *limits[1])
        nodes[node] = [f, float(cuts[f][k]), left, right, 0.0]
        return node

    if n and 0 < y.mean() < 1:
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            roots.append(grow(np.arange(n), p - y, p * (1 - p), 0, -np.inf, np.inf))
    a = np.array(nodes, float).reshape(-1, 5)
    return Trees(np.array(roots, int), a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int),
                 a[:, 3].astype(int), a[:, 4], depth, start if roots else 10.0)


# --- operators -------------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Features and qualities of the labelled documents with the smallest
    hashes, ``bound`` ids at most."""
    chosen = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
              .agg(F.min("quality").alias("quality"))
              .withColumn("_h", F.xxhash64(F.lit("quality"), "doc_id"))
              .orderBy("_h", "doc_id").limit(bound).select("doc_id", "quality"))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch):
                _, x = statistics(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"),
                     pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    rows = sample.select(F.col("doc_id").cast("long"), F.col("quality").cast("long"), "text") \
        .mapInArrow(features, "doc_id long, quality long, x array<double>") \
        .dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return x, np.array([float(r["quality"] > 0) for r in rows])


def fit_quality(docs: DataFrame, labels: DataFrame) -> Trees:
    x, y = training_rows(docs, labels)
    return fit_trees(x, y, list(FEATURES.values()))


def score_documents(docs: DataFrame, model: Trees, threshold: float = THRESHOLD,
                    keep_columns: bool = True) -> DataFrame:
    """``docs`` (or ``doc_id`` alone) with the base statistics, ``base_failed``,
    ``quality`` (estimated probability) and ``kept``."""
    added = [*BASE, "base_failed", "quality", "kept"]
    cols = [c for c in docs.columns if c not in added] if keep_columns else ["doc_id"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch):
                base, x = statistics(part.column("text"))
                failed = base_failed(base)
                p = model.probability(x)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in cols), *(pa.array(base[c]) for c in BASE),
                     pa.array(failed), pa.array(p), pa.array(~failed & (p >= threshold))],
                    [*cols, *added])

    schema = docs.select(*cols).schema
    for c in BASE:
        schema = schema.add(c, "long")
    schema = schema.add("base_failed", "boolean").add("quality", "double").add("kept", "boolean")
    return docs.select(*dict.fromkeys([*cols, "text"])).mapInArrow(score, schema)


def keep_good_documents(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the base rules and the model keep."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch):
                base, x = statistics(part.column("text"))
                good = ~base_failed(base) & (model.probability(x) >= threshold)
                yield part.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
