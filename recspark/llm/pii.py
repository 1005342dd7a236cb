"""Personal data: fixed patterns, and a character BiLSTM with a CRF on top.

The patterns give the base spans.  The network, written in numpy, reads windows
of ``WINDOW`` characters that overlap by half; a CRF over the tags (outside, and
begin / inside of each kind) decodes each window.  Spans of all windows of a
text are then reconciled: a span cut by a window's edge yields to one that is
seen whole, spans of one kind that overlap are joined, and of spans that
conflict the one with the higher score stays.  A span is added where it meets no
base span, holds a digit or an ``@``, and passes its kind's test (parts of an
address, digits, Luhn sum).  Windows without a digit or ``@`` can hold no such
span, so the network need not read them; the result is the same as if it did.

Training: labelled spans are the base spans of a bounded sample of windows
(``TRAIN_DOCS`` documents with the smallest hashes, ``TRAIN_WINDOWS`` windows),
and the same spans rewritten as the patterns miss them (a phone number without
its plus, a card number with dots, an address without a top-level domain).

Defined results: a null text is empty and has no span; offsets count code
points, end exclusive; equal rows get equal spans; a null id is like any other;
with nothing to learn from no span is added; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
#: 0 outside; 1 + 2k begins, 2 + 2k continues a span of kind k.
N_TAGS = 1 + 2 * len(KINDS)
WINDOW = 96
STRIDE = WINDOW // 2
HIDDEN = 24
TRAIN_DOCS = 800
TRAIN_WINDOWS = 1600
EPOCHS = 14
#: Mean posterior probability of a span's tags from which it is added.
MIN_SCORE = 0.7

Span = tuple[int, int, int]               # start, end, kind

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its first digit only; the matches are the same.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _ip_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _card_ok(s: str) -> bool:
    d = _digits(s)
    return 12 <= len(d) <= 19 and luhn(d)


def _phone_ok(s: str) -> bool:
    return 9 <= len(_digits(s)) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind."""
    out: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:                        # an address has one @; look around each
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            out.append((start, end, 0))
        at = text.find("@", max(at + 1, end))
    for kind, pattern, ok in ((1, _IP, _ip_ok), (2, _CARD, _card_ok), (3, _PHONE, _phone_ok)):
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if ok(m.group())]
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def spans_text(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in
                    sorted(spans, key=lambda s: (s[0], s[2], s[1])))


# --- the network -----------------------------------------------------------------

#: Character classes: ASCII as it is, other letters, other spaces, the rest, none.
N_CHARS = 132


def char_codes(text: str) -> np.ndarray:
    p = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.minimum(p, 128).astype(np.int64)
    for i in np.flatnonzero(p >= 128):
        c = chr(p[i])
        out[i] = 128 if c.isalpha() else 129 if c.isspace() else 130
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Network:
    """in_*: inputs to the four gates by character; rec_*: recurrent weights;
    out: both directions to tags; trans, first: the CRF's scores."""
    in_f: np.ndarray
    rec_f: np.ndarray
    in_b: np.ndarray
    rec_b: np.ndarray
    out: np.ndarray
    trans: np.ndarray
    first: np.ndarray

    NAMES = ("in_f", "rec_f", "in_b", "rec_b", "out", "trans", "first")


def _allowed() -> np.ndarray:
    """Which tag may follow which; a window may begin inside a span."""
    ok = np.ones((N_TAGS, N_TAGS), bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


_BAR = np.where(_allowed(), 0.0, -1e4).astype(np.float32)


def new_network(seed: int = 1, kind=np.float32) -> Network:
    r = np.random.default_rng(seed)
    h = HIDDEN

    def w(*shape):
        return r.normal(0, 1 / np.sqrt(shape[0] if shape[0] != N_CHARS else 16),
                        shape).astype(kind)

    n = Network(w(N_CHARS, 4 * h), w(h, 4 * h), w(N_CHARS, 4 * h), w(h, 4 * h),
                w(2 * h + 1, N_TAGS), np.zeros((N_TAGS, N_TAGS), kind), np.zeros(N_TAGS, kind))
    for x in (n.in_f, n.in_b):
        x[:, h:2 * h] += 1                # forget gates start open
    n.out[-1] = 0
    return n


def _lstm(codes: np.ndarray, w_in: np.ndarray, rec: np.ndarray, keep: bool):
    """Hidden states (time, batch, HIDDEN), and what the way back needs."""
    steps, batch = codes.shape
    h, c = np.zeros((batch, HIDDEN), w_in.dtype), np.zeros((batch, HIDDEN), w_in.dtype)
    hs, trace = np.empty((steps, batch, HIDDEN), w_in.dtype), []
    for t in range(steps):
        z = w_in[codes[t]] + h @ rec
        gates = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o = (gates[:, k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        if keep:
            trace.append((h, c, i, f, o, g))
        c = f * c + i * g
        h = o * np.tanh(c)
        hs[t] = h
    return hs, trace


def _lstm_back(codes, rec, hs, trace, d_hs, g_in, g_rec):
    """Adds the gradients of one direction to g_in and g_rec."""
    dh, dc = np.zeros_like(d_hs[0]), np.zeros_like(d_hs[0])
    all_dz = np.empty((*codes.shape, 4 * HIDDEN), d_hs.dtype)
    for t in range(len(codes) - 1, -1, -1):
        h0, c0, i, f, o, g = trace[t]
        tc = np.tanh(f * c0 + i * g)
        dh = dh + d_hs[t]
        dc = dc + dh * o * (1 - tc ** 2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o),
                             dc * i * (1 - g ** 2)], axis=1)
        all_dz[t] = dz
        g_rec += h0.T @ dz
        dh, dc = dz @ rec.T, dc * f
    one_hot = (codes.reshape(-1, 1) == np.arange(N_CHARS)).astype(all_dz.dtype)
    g_in += one_hot.T @ all_dz.reshape(-1, 4 * HIDDEN)


def emissions(n: Network, codes: np.ndarray, keep: bool = False):
    """Tag scores (time, batch, tags) of windows given as (time, batch) codes."""
    f, tf = _lstm(codes, n.in_f, n.rec_f, keep)
    b, tb = _lstm(codes[::-1], n.in_b, n.rec_b, keep)
    both = np.concatenate([f, b[::-1], np.ones((*codes.shape, 1), f.dtype)], axis=2)
    return both @ n.out, (both, f, tf, b, tb)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def posteriors(n: Network, e: np.ndarray):
    """Log alphas and betas of the CRF, and the log normaliser per window."""
    tr = n.trans + _BAR
    a, b = np.empty_like(e), np.zeros_like(e)
    a[0] = e[0] + n.first
    for t in range(1, len(e)):
        a[t] = e[t] + _logsum(a[t - 1][:, :, None] + tr, 1)
    for t in range(len(e) - 2, -1, -1):
        b[t] = _logsum(tr + (e[t + 1] + b[t + 1])[:, None, :], 2)
    return a, b, _logsum(a[-1], 1)


def viterbi(n: Network, e: np.ndarray) -> np.ndarray:
    """Best tags (time, batch)."""
    tr = n.trans + _BAR
    score, back = e[0] + n.first, np.zeros(e.shape, np.int8)
    for t in range(1, len(e)):
        s = score[:, :, None] + tr
        back[t] = s.argmax(axis=1)
        score = e[t] + s.max(axis=1)
    tags = np.empty(e.shape[:2], np.int8)
    tags[-1] = score.argmax(axis=1)
    rows = np.arange(e.shape[1])
    for t in range(len(e) - 1, 0, -1):
        tags[t - 1] = back[t, rows, tags[t]]
    return tags


def gradients(n: Network, codes: np.ndarray, tags: np.ndarray):
    """Mean negative log-likelihood of the tags, and its gradients."""
    steps, batch = codes.shape
    e, (both, f, tf, b, tb) = emissions(n, codes, keep=True)
    al, be, z = posteriors(n, e)
    g = {k: np.zeros_like(getattr(n, k)) for k in Network.NAMES}
    t_i, b_i = np.meshgrid(np.arange(steps), np.arange(batch), indexing="ij")
    true = (e[t_i, b_i, tags].sum(0) + n.first[tags[0]]
            + (n.trans + _BAR)[tags[:-1], tags[1:]].sum(0))
    de = np.exp(al + be - z[None, :, None])
    g["first"] = de[0].sum(0) - np.bincount(tags[0], minlength=N_TAGS)
    tr = n.trans + _BAR
    for t in range(1, steps):
        p = np.exp(al[t - 1][:, :, None] + tr + (e[t] + be[t])[:, None, :] - z[:, None, None])
        g["trans"] += p.sum(0)
    np.add.at(g["trans"], (tags[:-1].ravel(), tags[1:].ravel()), -1.0)
    de[t_i, b_i, tags] -= 1
    g["out"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, N_TAGS)
    dh = de @ n.out[:-1].T
    _lstm_back(codes, n.rec_f, f, tf, dh[:, :, :HIDDEN], g["in_f"], g["rec_f"])
    _lstm_back(codes[::-1], n.rec_b, b, tb, dh[::-1, :, HIDDEN:], g["in_b"], g["rec_b"])
    return float((z - true).mean()), {k: v / batch for k, v in g.items()}


def train_network(codes: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01,
                  batch: int = 64, seed: int = 1) -> Network:
    """Adam over shuffled batches of (window, time) codes and tags."""
    n = new_network(seed)
    r = np.random.default_rng(seed)
    m1 = {k: np.zeros_like(getattr(n, k)) for k in Network.NAMES}
    m2 = {k: np.zeros_like(getattr(n, k)) for k in Network.NAMES}
    step = 0
    for epoch in range(epochs):
        order = r.permutation(len(codes))
        lr = rate * (1 - epoch / epochs) + 0.001
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            _, g = gradients(n, codes[pick].T, tags[pick].T)
            size = np.sqrt(sum((v ** 2).sum() for v in g.values()))
            step += 1
            for k, v in g.items():
                v = v * min(1.0, 5.0 / max(size, 1e-12))
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.999 * m2[k] + 0.001 * v ** 2
                getattr(n, k)[...] -= (lr * m1[k] / (1 - 0.9 ** step)
                                       / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8))
    return n


# --- windows and their reconciliation --------------------------------------------

def window_starts(text: str) -> list[int]:
    """Starts of the grid's windows that hold a digit or ``@``."""
    out: list[int] = []
    for m in _TRIGGER.finditer(text):
        last = m.start() // STRIDE
        for k in (last - 1, last):
            if k >= 0 and (not out or out[-1] < k * STRIDE):
                out.append(k * STRIDE)
    return out


def _pad(text: str) -> np.ndarray:
    out = np.full(WINDOW, N_CHARS - 1, np.int64)
    codes = char_codes(text)
    out[:len(codes)] = codes
    return out


def read_windows(n: Network, windows: list[str], group: int = 2048
                 ) -> list[list[tuple[int, int, int, float, bool, bool]]]:
    """Of each window its spans: start, end, kind, score, cut at the front,
    cut at the back."""
    out = []
    for at in range(0, len(windows), group):
        some = windows[at:at + group]
        codes = np.array([_pad(w) for w in some]).T
        e, _ = emissions(n, codes)
        tags = viterbi(n, e).T
        al, be, z = posteriors(n, e)
        p = np.exp(al + be - z[None, :, None]).transpose(1, 0, 2)
        for i, w in enumerate(some):
            spans, t = [], tags[i, :len(w)]
            for s in np.flatnonzero((t > 0) & ((t % 2 == 1) | (np.arange(len(t)) == 0))):
                kind = (t[s] - 1) // 2
                stop = s + 1
                while stop < len(t) and t[stop] == 2 + 2 * kind:
                    stop += 1
                score = float(p[i, np.arange(s, stop), t[s:stop]].mean())
                spans.append((int(s), int(stop), int(kind), score, t[s] % 2 == 0,
                              stop == len(t) and len(w) == WINDOW))
            out.append(spans)
    return out


_PLAUSIBLE = (
    lambda s: 0 < s.find("@") < len(s) - 1 and s.count("@") == 1 and not re.search(r"\s", s),
    lambda s: len(re.findall(r"[0-9]+", s)) == 4 and max(
        int(p[-4:]) for p in re.findall(r"[0-9]+", s)) <= 255
    and not re.search(r"[0-9]{4}", s),
    _card_ok,
    _phone_ok,
)


def reconcile(text: str, found: list[tuple[int, int, int, float, bool, bool]],
              base: list[Span]) -> list[Span]:
    """Spans to add to ``base``, from a text's spans of all windows (in
    offsets of the text)."""
    whole = [f for f in found if not (f[4] or f[5])]
    # A cut span counts only where no window sees it whole; pieces are joined.
    seen = {}
    for kind in {f[2] for f in whole}:
        of_kind = sorted((f[0], f[1]) for f in whole if f[2] == kind)
        seen[kind] = ([s for s, _ in of_kind], list(accumulate((e for _, e in of_kind), max)))
    cut = sorted(f for f in found if (f[4] or f[5]) and not _reaches(seen.get(f[2]), f[0], f[1]))
    for f in cut:
        if whole and whole[-1][2] == f[2] and f[0] <= whole[-1][1] and (whole[-1][4]
                                                                       or whole[-1][5]):
            a = whole.pop()
            f = (min(a[0], f[0]), max(a[1], f[1]), f[2], min(a[3], f[3]), a[4], True)
        whole.append(f)
    starts, ends = _union(base)
    out: list[Span] = []
    for s, e, kind, score, _, _ in sorted(whole, key=lambda f: (-f[3], f[0], f[2], -f[1])):
        while s < e and text[s] in " .,;:":
            s += 1
        while e > s and text[e - 1] in " .,;:":
            e -= 1
        # Taken spans lie apart and in order: only the last one that begins before e counts.
        at = bisect_left(starts, e)
        if at and ends[at - 1] > s:
            continue
        piece = text[s:e]
        if score >= MIN_SCORE and _TRIGGER.search(piece) and _PLAUSIBLE[kind](piece):
            starts.insert(at, s)
            ends.insert(at, e)
            out.append((s, e, kind))
    return out


def _reaches(spans: tuple[list[int], list[int]] | None, start: int, end: int) -> bool:
    """Whether one of the spans (starts in order, largest ends so far) overlaps."""
    at = bisect_left(spans[0], end) if spans else 0
    return bool(at) and spans[1][at - 1] > start


def _union(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of spans, in order."""
    starts, ends = [], []
    for s, e, _ in sorted(spans):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def find_spans(texts: list[str | None], network: Network | None
               ) -> Iterator[tuple[list[Span], list[Span]]]:
    """(base, added) spans of each text."""
    for at in range(0, len(texts), 500):
        some = [t or "" for t in texts[at:at + 500]]
        base = [base_spans(t) if _TRIGGER.search(t) else [] for t in some]
        starts = [window_starts(t) if network else [] for t in some]
        windows = [t[s:s + WINDOW] for t, ss in zip(some, starts) for s in ss]
        read = iter(read_windows(network, windows)) if network else iter(())
        for t, b, ss in zip(some, base, starts):
            found = [(s + x[0], s + x[1], *x[2:4], bool(x[4] and s > 0),
                      bool(x[5] and s + WINDOW < len(t))) for s in ss for x in next(read)]
            yield b, reconcile(t, found, b) if found else []


# --- training rows ---------------------------------------------------------------

def _rewrite(piece: str, kind: int, pick: int) -> str:
    """A span as the patterns miss it; the same span where there is no way."""
    if kind == 3:
        d = _digits(piece)
        if len(d) < 10:
            return piece
        n = d[-10:]
        return (f"({n[:3]}) {n[3:6]}-{n[6:]}", f"{n[:3]}-{n[3:6]}-{n[6:]}",
                f"{n[:3]}.{n[3:6]}.{n[6:]}")[pick % 3]
    if kind == 2:
        d = _digits(piece)
        sep = "./_"[pick % 3]
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))
    if kind == 0:
        return piece[:piece.index("@")] + "@" + piece[piece.index("@") + 1:].split(".")[0]
    d = piece.split(".")
    return ("-".join(d), "[.]".join(d), " . ".join(d))[pick % 3]


def training_windows(text: str) -> Iterator[tuple[int, str, list[Span]]]:
    """(hash, window, spans) for learning: each grid window with a digit or
    ``@``, and, where it holds a span, once more with a span rewritten."""
    base = base_spans(text)
    order = sorted(range(len(base)), key=lambda i: base[i][0])
    begins = [base[i][0] for i in order]
    reach = list(accumulate((base[i][1] for i in order), max))
    for start in window_starts(text):
        w = text[start:start + WINDOW]
        # Spans in order of their start: before the first none reaches the window.
        some = sorted(order[bisect_right(reach, start):bisect_left(begins, start + len(w))])
        inside = [(max(s - start, 0), min(e - start, len(w)), k) for s, e, k in
                  map(base.__getitem__, some) if e > start]
        h = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=7).digest())
        yield h, w, inside
        whole = [x for x in inside if (x[0] > 0 or start == 0) and x[1] < len(w)]
        if whole:
            s, e, k = whole[h % len(whole)]
            new = _rewrite(w[s:e], k, h // 7)
            moved = w[:s] + new + w[e:]
            shift = len(new) - (e - s)
            spans = [(s, s + len(new), k)] + [
                (a + shift * (a >= e), b + shift * (a >= e), q) for a, b, q in inside
                if (a, b, q) != (s, e, k) and (b <= s or a >= e)]
            yield h + 1, moved[:WINDOW], [(a, min(b, WINDOW), q) for a, b, q in spans if a < WINDOW]


def _tags(length: int, spans: list[Span]) -> np.ndarray:
    t = np.zeros(WINDOW, np.int64)
    for s, e, k in sorted(spans, key=lambda x: -x[2]):
        t[s:e] = 2 + 2 * k
        t[s] = 1 + 2 * k
    t[length:] = 0
    for i in range(1, WINDOW):            # an overlap may have cut a span's begin off
        if t[i] and t[i] % 2 == 0 and t[i - 1] not in (t[i], t[i] - 1):
            t[i] -= 1
    return t


def fit_network(docs: DataFrame, train_docs: int = TRAIN_DOCS,
                train_windows: int = TRAIN_WINDOWS) -> Network | None:
    """Train on a bounded sample of documents that hold a digit or ``@``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for t in batch.column("text").to_pylist() for r in training_windows(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.string()),
                 pa.array([[x for s in r[2] for x in s] for r in rows], pa.list_(pa.int32()))],
                ["h", "w", "s"])

    texts = (docs.where(F.col("text").rlike("[0-9@]")).select("text")
             .withColumn("_h", F.xxhash64(F.lit("pii"), "text")))
    # The largest of the sample's hashes first, from hashes alone; then its texts.
    last = (texts.select("_h").distinct().orderBy("_h").limit(train_docs)
            .agg(F.max("_h")).first()[0])
    sample = texts.where(F.col("_h") <= F.lit(last)).dropDuplicates(["_h"]).select("text")
    rows = (sample.mapInArrow(cut, "h long, w string, s array<int>").distinct()
            .orderBy("h", "w", "s").limit(train_windows).collect())
    if not rows:
        return None
    spans = [[tuple(r["s"][i:i + 3]) for i in range(0, len(r["s"]), 3)] for r in rows]
    codes = np.array([_pad(r["w"]) for r in rows])
    tags = np.array([_tags(len(r["w"]), s) for r, s in zip(rows, spans)])
    return train_network(codes, tags)


def find_personal_data(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id and, of every row, the counts and digest of base spans, and all
    spans as text."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digest, spans = [], [], []
            for base, added in find_spans(batch.column("text").to_pylist(), network):
                counts.append([sum(s[2] == k for s in base) for k in range(len(KINDS))])
                digest.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                spans.append(spans_text(base + added))
            table = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(table[:, k]) for k in range(len(KINDS))),
                 pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = docs.select("doc_id").schema
    for k in KINDS:
        schema = schema.add(f"n_{k}", "long")
    schema = schema.add("base_sha256", "string").add("spans", "string")
    return docs.select("doc_id", "text").mapInArrow(find, schema)


def mask_personal_data(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets."""
    columns = docs.columns

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = []
            for t, (base, added) in zip(texts, find_spans(texts, network)):
                at, parts = 0, []
                for s, e, k in sorted(base + added):
                    if s >= at:
                        parts += [t[at:s], f"[{KINDS[k]}]"]
                    at = max(at, e)
                out.append(t if t is None else "".join(parts) + t[at:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()) if c == "text" else batch.column(c) for c in columns],
                columns)

    return docs.mapInArrow(mask, docs.schema)
