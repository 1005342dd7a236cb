"""Byte-level BPE over a contiguous rank array, for many short words at once.

A text is cut at white space into chunks, a chunk by the vocabulary's pattern
into words.  Each distinct word is encoded once per task and kept in a bounded
cache.  Words of one length form a matrix: a row holds the part ids left of
each boundary and, beside them, the rank of merging each part with the next.
All rows scan for their minimum together, delete that boundary by moving the
rest one place left, and refresh the two neighbouring ranks, until no row has a
rank.  A word longer than ``SHORT`` bytes goes through a heap of ranks with
linked parts instead, which does the same merges in n log n steps.

The vocabulary file is a parameter.  It is read on the driver and reaches the
tasks with their function (a fixed file of some 50,000 entries, 1.4 MB), so
executors need not have it.

Defined results: a null text is the empty one; the strings of special tokens
are found before anything else, the first and longest one winning, and become
their ids; equal rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

#: Words up to this many bytes are encoded in matrices.
SHORT = 48
#: Distinct chunks kept by a task, and their characters; the cache starts anew beyond.
CACHE_CHUNKS = 600_000
CACHE_CHARS = 16 << 20
#: Characters of text encoded together.
GROUP_CHARS = 4 << 20
#: Code points with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The cutting pattern of the vocabulary (a fixed value of its format).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_NONE = np.int32(2 ** 31 - 1)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Vocabulary:
    """Ids, merges and special tokens of a byte-level BPE file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        ids: dict[str, int] = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        back = {c: b for b, c in enumerate(byte_characters())}
        size = max([*ids.values(), *special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            if token not in special:
                self.bytes[i] = bytes(back[c] for c in token)
        for token, i in special.items():
            self.bytes[i] = token.encode()
        self.size = size
        self.special = special
        self.byte_id = np.array([ids[c] for c in byte_characters()], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        pair = left * size + right
        order = np.argsort(pair)
        self.pair = pair[order]
        self.rank = np.arange(len(merges), dtype=np.int32)[order]
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of merging each pair; _NONE where there is no merge."""
        if not len(self.pair):
            return np.full(left.shape, _NONE, np.int32)
        want = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pair, want)
        at[at == len(self.pair)] = 0
        return np.where(self.pair[at] == want, self.rank[at], _NONE)


def encode_short(v: Vocabulary, words: np.ndarray) -> list[bytes]:
    """Ids (as int32 bytes) of words of one length, given as a byte matrix."""
    n, length = words.shape
    part = v.byte_id[words]
    rank = np.full((n, length), _NONE, np.int32)      # of a part and the next one
    if length > 1:
        rank[:, :-1] = v.ranks(part[:, :-1], part[:, 1:])
    count = np.full(n, length)
    out = [b""] * n
    row, col = np.arange(n), np.arange(length)
    while len(row):
        k = np.arange(len(row))
        at = rank.argmin(axis=1)
        least = rank[k, at]
        go = least != _NONE
        for i in np.flatnonzero(~go).tolist():
            out[row[i]] = part[i, :count[i]].tobytes()
        if not go.all():
            row, part, rank, count, at, least = (
                x[go] for x in (row, part, rank, count, at, least))
            k = np.arange(len(row))
        if not len(row):
            break
        part[k, at] = v.merged[least]
        # Delete the boundary behind the merged part: the rest moves left.
        width = int(count.max())
        source = np.minimum(col[:width] + (col[:width] > at[:, None]), width - 1)
        part = np.take_along_axis(part[:, :width], source, 1)
        rank = np.take_along_axis(rank[:, :width], source, 1)
        count = count - 1
        rank[k, count - 1] = _NONE                     # the last part has no next one
        rank[k, np.minimum(count, width - 1)] = _NONE  # nor what stood behind it
        for shift in (0, -1):                          # refresh both neighbouring ranks
            i = at + shift
            has = np.flatnonzero((i >= 0) & (i + 1 < count))
            i = i[has]
            rank[has, i] = v.ranks(part[has, i], part[has, i + 1])
    return out


def encode_long(v: Vocabulary, word: bytes) -> bytes:
    """Ids (as int32 bytes) of one word by a heap of ranks over linked parts."""
    part = v.byte_id[np.frombuffer(word, np.uint8)].tolist()
    n = len(part)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    first = v.ranks(np.array(part[:-1]), np.array(part[1:])).tolist()
    heap = [(r, i, part[i], part[i + 1]) for i, r in enumerate(first) if r != _NONE]
    heapq.heapify(heap)

    def offer(i: int, j: int) -> None:
        r = int(v.ranks(np.array([part[i]]), np.array([part[j]]))[0])
        if r != _NONE:
            heapq.heappush(heap, (r, i, part[i], part[j]))

    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if part[i] != a or j >= n or part[j] != b:
            continue
        part[i], part[j] = int(v.merged[r]), -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            offer(i, after[i])
        if before[i] >= 0:
            offer(before[i], i)
    return np.array([p for p in part if p >= 0], np.int32).tobytes()


class Tokenizer:
    """Encodes and decodes texts; keeps the ids of chunks it has met."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = PATTERN):
        self.v = vocabulary
        self._words = regex.compile(pattern.replace(r"\S", f"[^{WHITE}]").replace(
            r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]"))
        # White space always ends a word, so a chunk's cut is the whole text's.
        self._chunks = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        names = sorted(vocabulary.special, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, names))) if names else None
        self._cache: dict[str, bytes] = {}
        self._held = 0

    def _cut(self, chunk: str) -> list[str]:
        """The words of a chunk; letters, and letters before one mark, are
        plain without the pattern."""
        body = chunk[1:] if chunk[0] == " " else chunk
        if body.isalpha():
            return [chunk]
        if body[:-1].isalpha() and body[-1] in ".,;:!?":
            return [chunk[:-1], body[-1]]
        return self._words.findall(chunk)

    def _encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        by_length: dict[int, tuple[list[str], list[bytes]]] = {}
        out = {}
        for w in words:
            b = w.encode()
            if len(b) <= SHORT:
                names, rows = by_length.setdefault(len(b), ([], []))
                names.append(w)
                rows.append(b)
            else:
                out[w] = encode_long(self.v, b)
        for length, (names, rows) in by_length.items():
            for at in range(0, len(rows), 4000):
                m = np.frombuffer(b"".join(rows[at:at + 4000]), np.uint8).reshape(-1, length)
                out.update(zip(names[at:at + 4000], encode_short(self.v, m)))
        return out

    def _learn(self, chunks: set[str]) -> None:
        cache = self._cache
        if len(cache) > CACHE_CHUNKS or self._held > CACHE_CHARS:
            cache.clear()
            self._held = 0
        if not cache:  # a special token's string is never part of another chunk
            cache.update((t, np.int32(i).tobytes()) for t, i in self.v.special.items())
        new = [c for c in chunks if c not in cache]
        self._held += sum(map(len, new))
        cut = list(map(self._cut, new))
        ids = self._encode_words(set(chain.from_iterable(cut)))
        for c, words in zip(new, cut):
            cache[c] = ids[words[0]] if len(words) == 1 else b"".join(
                map(ids.__getitem__, words))

    def _pieces(self, text: str) -> list[str]:
        """Chunks and, between them, the strings of special tokens."""
        if self._special is None or not self._special.search(text):
            return self._chunks.findall(text)
        out, at = [], 0
        for m in self._special.finditer(text):
            out += self._chunks.findall(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._chunks.findall(text[at:])

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids (int32) of each text, worked on in groups of texts."""
        start = 0
        while start < len(texts):
            stop, held = start, 0
            while stop < len(texts) and held < GROUP_CHARS:
                held += len(texts[stop] or "")
                stop += 1
            cut = [self._pieces(t or "") for t in texts[start:stop]]
            self._learn(set().union(*cut))
            for pieces in cut:
                yield np.frombuffer(b"".join(map(self._cache.__getitem__, pieces)), np.int32)
            start = stop

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.v.bytes.__getitem__, ids)).decode("utf-8", "replace")


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        return Vocabulary(f.read())


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, with_ids: bool = True) -> DataFrame:
    """The columns of ``docs`` with ``token_ids``, ``n_tokens``, ``ids_sha256``
    and ``decoded_sha256`` (of the text decoded from the ids).

    Without ``with_ids`` and for other columns than ``doc_id`` nothing more
    than the digests leaves the task.
    """
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    kept = [c for c in docs.columns if c not in
            ("token_ids", "n_tokens", "ids_sha256", "decoded_sha256")]
    if not with_ids:
        kept = ["doc_id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tokenizer(vocabulary)
        as_text = [str(i) for i in range(vocabulary.size)]
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                count, ids_hash, text_hash, all_ids = [], [], [], []
                for row in t.encode(batch.column("text").to_pylist()):
                    ids = row.tolist()
                    count.append(len(ids))
                    ids_hash.append(hashlib.sha256(
                        ",".join(map(as_text.__getitem__, ids)).encode()).hexdigest())
                    text_hash.append(hashlib.sha256(t.decode(ids).encode()).hexdigest())
                    if with_ids:
                        all_ids.append(row)
                columns = [batch.column(c) for c in kept]
                if with_ids:
                    columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                columns += [pa.array(count, pa.int64()), pa.array(ids_hash, pa.string()),
                            pa.array(text_hash, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    columns, [*kept, *(["token_ids"] if with_ids else []), "n_tokens",
                              "ids_sha256", "decoded_sha256"])

    schema = docs.select(*kept).schema
    if with_ids:
        schema = schema.add("token_ids", ArrayType(IntegerType()))
    for field in added.split(", "):
        schema = schema.add(*field.split(" "))
    needed = docs if with_ids else docs.select("doc_id", "text")
    return needed.mapInArrow(encode, schema)
