"""Language identification by hyperdimensional letter profiles.

Every letter, and the gap between words, has a random vector of +1 and -1 in
``DIMENSIONS`` dimensions, made from its code point.  The vector of a run of
three is the product of the letters' vectors, shifted by two, one and no places
(binding); a document's vector is the sum over its runs (bundling).  A language
prototype bundles the unit vectors of its training documents, and a document
gets the language with the largest cosine.

Learning uses a bounded sample: of each language the documents whose hash is
below ``TRAIN_DOCS / n``, so that ``TRAIN_DOCS`` are expected.  Unit vectors are
rounded to whole multiples of 2**-24 and summed as integers by Spark, so the
prototypes don't depend on the order of rows.  Languages are a closed set of
labels; prototypes take ``DIMENSIONS`` numbers each.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
and so is every text when nothing could be learned; equal cosines give the
language first in order; a null id is neither held out nor learned from; equal
rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import text_chunks
from recspark.llm.text_arrays import mix

DIMENSIONS = 1024
#: Expected documents a language is learned from.
TRAIN_DOCS = 1500
UNDETERMINED = "und"
_CHUNK = 1 << 20
#: Runs whose vectors a task keeps.
_CACHE_RUNS = 16_384
#: Distinct runs bound at once where a chunk has more than the cache holds.
_SLICE = 4_096
_UNIT = float(1 << 24)
_GAP = 32
_U = np.uint64

def letters_of(points: np.ndarray) -> np.ndarray:
    """Which of the code points are letters."""
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    found = np.flatnonzero(seen)
    seen[found] = [chr(i).isalpha() for i in found.tolist()]
    return seen[points]


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """A row of +1 and -1 for each code point."""
    block = np.arange(DIMENSIONS // 64, dtype=_U)
    bits = mix(mix(points.astype(_U) + _U(0x1234567))[:, None] + block * _U(0x9E3779B97F4A7C15))
    ones = np.unpackbits(bits.view(np.uint8).reshape(len(points), -1), axis=1)
    return ones.astype(np.int8) * 2 - 1


def run_vectors(runs: np.ndarray) -> np.ndarray:
    """Bound vectors of runs, coded as three 21-bit code points."""
    out = np.ones((len(runs), DIMENSIONS), np.int8)
    for shift in (2, 1, 0):
        points, at = np.unique((runs >> (21 * shift)) & 0x1FFFFF, return_inverse=True)
        out *= np.roll(letter_vectors(points), shift, axis=1)[at]
    return out


def letter_runs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, run) of every run of three, and which texts have a letter.

    Letters are lower-cased; all between words is one gap, as are both ends.
    """
    joined = "\0".join(f" {(t or '').replace(chr(0), ' ')} " for t in texts).lower()
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.cumsum(points == 0)
    letter = letters_of(points)
    # Of the characters between words only the first stays.
    keep = letter | np.append(True, letter[:-1] | (points[:-1] == 0)) if len(points) else letter
    keep &= points != 0
    doc = doc[keep]
    symbol = np.where(letter[keep], points[keep], _GAP).astype(np.int64)
    has = np.bincount(doc[symbol != _GAP], minlength=len(texts)) > 0
    if len(symbol) < 3:
        return np.zeros(0, int), np.zeros(0, np.int64), has
    runs = symbol[:-2] << 42 | symbol[1:-1] << 21 | symbol[2:]
    inside = doc[:-2] == doc[2:]
    return doc[:-2][inside], runs[inside], has


class Profiler:
    """Document vectors; keeps the vectors of runs it has met."""

    def __init__(self) -> None:
        self._known = np.zeros(0, np.int64)
        self._vectors = np.zeros((0, DIMENSIONS), np.float32)

    def _lookup(self, runs: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct runs."""
        if len(self._known) > _CACHE_RUNS:
            self.__init__()
        new = np.setdiff1d(runs, self._known, assume_unique=True)
        if len(new):
            known = np.concatenate([self._known, new])
            order = np.argsort(known)
            self._vectors = np.concatenate([self._vectors, run_vectors(new)])[order].astype(
                np.float32, copy=False)
            self._known = known[order]
        if len(runs) == len(self._known):
            return self._vectors
        return self._vectors[np.searchsorted(self._known, runs)]

    @staticmethod
    def _distinct(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct runs and each run's place among them."""
        seen = np.zeros(0x110000, bool)
        for shift in (0, 21, 42):
            seen[(runs >> shift) & 0x1FFFFF] = True
        alphabet = np.flatnonzero(seen)
        a = len(alphabet)
        if a ** 3 > 1 << 22:
            return np.unique(runs, return_inverse=True)
        small = np.zeros(0x110000, np.int32)
        small[alphabet] = np.arange(a)
        code = (small[runs >> 42] * a + small[(runs >> 21) & 0x1FFFFF]) * a + small[runs & 0x1FFFFF]
        found = np.flatnonzero(np.bincount(code, minlength=a ** 3))
        place = np.zeros(a ** 3, np.int32)
        place[found] = np.arange(len(found))
        x, y, z = found // (a * a), found // a % a, found % a
        return alphabet[x] << 42 | alphabet[y] << 21 | alphabet[z], place[code]

    def vectors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(len(texts) x DIMENSIONS) sums and which texts have a letter."""
        doc, runs, has = letter_runs(texts)
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        if not len(runs):
            return out, has
        distinct, place = self._distinct(runs)
        if len(distinct) > _CACHE_RUNS:
            # Many letters: the sums are whole numbers, so slices of runs add up exactly.
            order = np.argsort(place, kind="stable")
            place, doc = place[order], doc[order]
            cuts = np.searchsorted(place, np.arange(0, len(distinct) + _SLICE, _SLICE))
            for at, s, e in zip(range(0, len(distinct), _SLICE), cuts[:-1], cuts[1:]):
                bound = run_vectors(distinct[at:at + _SLICE]).astype(np.float32)
                again = np.argsort(doc[s:e], kind="stable")
                self._add(out, doc[s:e][again], place[s:e][again] - at, bound)
        else:
            self._add(out, doc, place, self._lookup(distinct))
        return out, has

    @staticmethod
    def _add(out: np.ndarray, doc: np.ndarray, place: np.ndarray, bound: np.ndarray) -> None:
        """Adds the vectors ``bound[place]`` to the rows ``doc`` (ascending) of ``out``."""
        k = len(bound)
        rows = max(1, (1 << 22) // k)      # documents whose counts fit into 16 MB
        starts = np.searchsorted(doc, np.arange(0, len(out) + rows, rows))
        for i, at in enumerate(range(0, len(out), rows)):
            part = slice(starts[i], starts[i + 1])
            n = min(rows, len(out) - at)
            if starts[i + 1] > starts[i]:
                count = np.bincount((doc[part] - at) * k + place[part], minlength=n * k)
                out[at:at + n] += count.reshape(n, k).astype(np.float32) @ bound


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return x / np.where(size > 0, size, 1)


def id_bucket(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; 1 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def learn_prototypes(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> dict[str, np.ndarray]:
    """Language -> bundle of the unit vectors of its sampled documents."""
    usable = docs.where("lang is not null and text is not null").where(id_bucket() != 1)
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return {}
    hashed = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == F.lit(lang), F.lit(train_docs / n)).otherwise(share)
    sample = usable.select("lang", "text").where(hashed < share)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(), {}
        for batch in batches:
            for part in text_chunks(batch, chunk_bytes=_CHUNK):
                x, _ = profiler.vectors(part.column("text").to_pylist())
                whole = np.rint(_unit(x) * _UNIT).astype(np.int64)
                for lang, row in zip(part.column("lang").to_pylist(), whole):
                    sums[lang] = sums.get(lang, 0) + row
        for lang, row in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)),
                 pa.array(row)], ["lang", "i", "v"])

    rows = (sample.mapInArrow(bundle, "lang string, i int, v long")
            .groupBy("lang", "i").agg(F.sum("v").alias("v")).collect())
    out = {r["lang"]: np.zeros(DIMENSIONS) for r in rows}
    for r in rows:
        out[r["lang"]][r["i"]] = r["v"]
    return out


def predict_language(docs: DataFrame, prototypes: dict[str, np.ndarray],
                     keep_columns: bool = True) -> DataFrame:
    """``docs`` (or ``doc_id`` alone) with ``lang_pred`` and ``score``, the
    cosine, 0 at least."""
    cols = ([c for c in docs.columns if c not in ("lang_pred", "score")] if keep_columns
            else ["doc_id"])
    names = sorted(prototypes)
    matrix = _unit(np.array([prototypes[x] for x in names])).T if names else None

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler()
        for batch in batches:
            for part in text_chunks(batch, chunk_bytes=_CHUNK):
                texts = part.column("text").to_pylist()
                if matrix is None:
                    lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                else:
                    x, has = profiler.vectors(texts)
                    cosine = _unit(x) @ matrix
                    best = cosine.argmax(axis=1)
                    lang = [names[b] if h else UNDETERMINED for b, h in zip(best, has)]
                    score = np.where(has, np.clip(cosine.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in cols), pa.array(lang, pa.string()),
                     pa.array(score)], [*cols, "lang_pred", "score"])

    schema = docs.select(*cols).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*dict.fromkeys([*cols, "text"])).mapInArrow(predict, schema)


def identify_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    predicted = predict_language(docs.select("doc_id", "text"), learn_prototypes(docs),
                                 keep_columns=False)
    return predicted.select("doc_id", F.coalesce(id_bucket() == 1, F.lit(False)).alias("held_out"),
                            "lang_pred", "score")
