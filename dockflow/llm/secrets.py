"""Operator 5: secret scans with a linear-chain conditional random field.

The base scan finds three fixed kinds of match.  The field tags tokens as secret begin, inside or outside from the shape of a token,
its neighbours (words and shapes) and the file's make-up, and adds the spans that the base scan doesn't cover.  It learns
from a bounded sample of documents, where the values that the base scan finds are the secrets.  So that it finds what the fixed
kinds miss, it also sees the long ones in disguise: without the name and the sign that led to them, and drawn anew from other alphabets.

Tokens, features and emissions are arrays over a batch.  Decoding is Viterbi: a token is certainly outside where no choice
of neighbours could repay another tag, so the best path is decoded run by run of the other tokens, and is the same.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from . import store

ASSIGN = re.compile(rb"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")
_STEMS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

#: Documents that the field is fitted on (expected number), windows and tokens of a window, at most.
SAMPLE_DOCS = 6_000
WINDOWS, SPAN = 3_000, 31
ROUNDS = 80
#: Values of so many bytes are shown in disguise, with so many bytes of text on either side, drawn from these alphabets.
DISGUISED_FROM, MARGIN = 16, 160
ALPHABETS = (b"0123456789ABCDEF", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", b"abcdefghijklmnopqrstuvwxyz0123456789")
SLOTS = 1 << 16
OUT, BEGIN, INSIDE = 0, 1, 2

_CLASS = np.full(256, 2, np.uint8)  # 0 white space, 1 token bytes, 2 symbols
_CLASS[K.IS_SPACE] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.-", *range(128, 256)]] = 1
_UP, _LOW, _DIGIT = (np.zeros(256, np.int32) for _ in range(3))
_UP[65:91], _LOW[97:123], _DIGIT[48:58] = 1, 1, 1
_HEXES = np.zeros(256, bool)
_HEXES[[*b"0123456789abcdef"]] = True


def base_spans(text: bytes) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, value start, value end) of the fixed kinds, in bytes."""
    out = [(0, *m.span(), *m.span(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(1, *m.span(), *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(2, *m.span(), *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return out


def _suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may hold a base span: all that do, and few others."""
    at = []
    lower, raw = K.LOWER[data].tobytes(), data.tobytes()
    for text, stem in [(lower, s) for s in _STEMS] + [(raw, b"AKIA")]:
        i = text.find(stem)
        while i >= 0:
            at.append(i)
            i = text.find(stem, i + 1)
    live = np.diff(np.concatenate([[0], _HEXES[data].view(np.int8), [0]]))
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    edge = np.unique(edge[_HEXES[data[edge - 1]] & _HEXES[data[edge]]])  # a run goes on in the next row: two runs
    begin, end = (np.sort(np.concatenate([np.flatnonzero(live == x), edge])) for x in (1, -1))
    at += begin[end - begin >= 24].tolist()
    return np.unique(np.searchsorted(offsets, np.array(at, np.int64), "right") - 1) if at else np.zeros(0, np.int64)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each token: runs of token bytes, and runs of symbols."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    kind = _CLASS[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    cut = np.flatnonzero(change)
    keep = kind[cut[:-1]] > 0
    starts, ends = cut[:-1][keep], cut[1:][keep]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Slots (tokens x features) of all tokens of a batch."""
    sums = [np.concatenate([[0], np.cumsum(t[data])]) for t in (_UP, _LOW, _DIGIT)]
    up, low, digit = (s[ends] - s[starts] for s in sums)
    size = ends - starts
    code = _UP[data] + 2 * _LOW[data] + 3 * _DIGIT[data]
    turns = np.concatenate([[0], np.cumsum(np.concatenate([[0], code[1:] != code[:-1]]))])
    turn = turns[ends] - turns[np.minimum(starts + 1, ends)]
    length = np.minimum(np.log2(np.maximum(size, 1)) * 2, 15).astype(np.int64)
    digits = np.minimum(digit * 4 // np.maximum(size, 1) + (digit > 0), 5)
    case = (up > 0) * 2 + (low > 0) + 4 * (_CLASS[data[starts]] == 2)
    change = np.minimum(np.log2(turn + 1), 6).astype(np.int64)
    shape = ((length * 6 + digits) * 8 + case) * 8 + change
    word = K.range_hashes(K.LOWER[data], starts, ends)
    per = np.maximum(np.bincount(rows, minlength=n), 1)
    file = np.minimum((np.bincount(rows, digit > 0, n) * 64 / per).astype(np.int64), 7) * 8 + np.minimum((np.bincount(rows, case >= 4, n) * 16 / per).astype(np.int64), 7)

    def neighbour(x, k, none):
        out = np.full(len(x), none, x.dtype)
        if k < 0:
            ok = rows[-k:] == rows[:k]
            out[-k:][ok] = x[:k][ok]
        else:
            ok = rows[:-k] == rows[k:]
            out[:-k][ok] = x[k:][ok]
        return out

    none = K.U64(0x51ED270B)
    text = np.where(digits > 0, shape.astype(np.uint64), word)  # a neighbour with digits is known by its shape
    coarse = (length // 3) * 48 + digits * 8 + case
    streams = [
        shape, length * 8 + case, digits * 8 + change, coarse * 64 + file[rows],
        neighbour(text, -1, none), neighbour(text, -2, none), neighbour(text, 1, none),
        neighbour(text, -1, none) ^ K.mix(neighbour(text, -2, none)),
        neighbour(coarse, -1, -1) * 4096 + coarse, neighbour(coarse, 1, -1) * 4096 + coarse,
    ]
    return np.stack([(K.mix(s.astype(np.uint64) * K.U64(0x9E3779B97F4A7C15) + K.U64(i + 1)) >> K.U64(48)).astype(np.int32) for i, s in enumerate(streams)], axis=1)


def fit(slots: np.ndarray, tags: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Emission (slots x 3) and transition (3 x 3) weights: gradient ascent on the conditional likelihood of windows
    (windows x tokens x features), all windows at a time, by forward and backward sums."""
    w, t = np.zeros((SLOTS, 3)), np.zeros((3, 3))
    gw2, gt2 = np.full((SLOTS, 3), 1e-6), np.full((3, 3), 1e-6)
    n, m, f = slots.shape
    if not n:
        return w.astype(np.float32), t.astype(np.float32)
    gold = np.eye(3)[tags] * real[:, :, None]
    both = real[:, 1:] & real[:, :-1]
    gold_t = np.einsum("nia,nib->ab", gold[:, :-1] * both[:, :, None], gold[:, 1:])
    flat = slots.reshape(-1)

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for _ in range(ROUNDS):
        e = w[slots].sum(axis=2)
        a, b = np.zeros((n, m, 3)), np.zeros((n, m, 3))
        a[:, 0] = e[:, 0]
        for i in range(1, m):
            step = lse(a[:, i - 1, :, None] + t, 1) + e[:, i]
            a[:, i] = np.where(real[:, i, None], step, a[:, i - 1])
        for i in range(m - 2, -1, -1):
            step = lse(t + (e[:, i + 1] + b[:, i + 1])[:, None, :], 2)
            b[:, i] = np.where(real[:, i + 1, None], step, 0.0)
        z = lse(a[:, -1], 1)
        p = np.exp(np.minimum(a + b - z[:, None, None], 0)) * real[:, :, None]
        pair = np.exp(np.minimum(a[:, :-1, :, None] + t + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None], 0)) * both[:, :, None, None]
        gap = (gold - p).reshape(-1, 3)
        g = np.stack([np.bincount(flat, np.repeat(gap[:, k], f), SLOTS) for k in range(3)], axis=1) - 0.01 * w
        gt = gold_t - pair.sum(axis=(0, 1)) - 0.01 * t
        gw2 += g * g
        gt2 += gt * gt
        w += 0.3 * g / np.sqrt(gw2)
        t += 0.3 * gt / np.sqrt(gt2)
    return w.astype(np.float32), t.astype(np.float32)


def viterbi(e: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Tags of one sequence of emissions (tokens x 3)."""
    best, back = e[0].copy(), np.zeros((len(e), 3), np.int64)
    for i in range(1, len(e)):
        score = best[:, None] + t
        back[i] = score.argmax(axis=0)
        best = score.max(axis=0) + e[i]
    tags = np.zeros(len(e), np.int64)
    tags[-1] = best.argmax()
    for i in range(len(e) - 1, 0, -1):
        tags[i - 1] = back[i, tags[i]]
    return tags


def decode(e: np.ndarray, rows: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Best tags of every row's sequence. A token whose lead for outside is more than its neighbours could repay is outside
    on the best path, whatever their tags; a neighbour that is known to be outside, or missing, repays what it does, not the most."""
    tags = np.zeros(len(e), np.int64)
    if not len(e):
        return tags
    lead = e[:, OUT, None] - e[:, 1:]
    left_gain, right_gain = t[:, 1:] - t[:, OUT, None], (t[1:, :] - t[OUT, :]).T  # neighbour x secret tag
    first, last = np.ones(len(e), bool), np.ones(len(e), bool)
    first[1:], last[:-1] = rows[1:] != rows[:-1], rows[1:] != rows[:-1]
    sure = np.zeros(len(e), bool)
    for _ in range(6):
        before, after = np.concatenate([[False], sure[:-1]]), np.concatenate([sure[1:], [False]])
        left = np.where(first[:, None], 0.0, np.where(before[:, None], left_gain[OUT], left_gain.max(axis=0)))
        right = np.where(last[:, None], 0.0, np.where(after[:, None], right_gain[OUT], right_gain.max(axis=0)))
        more = (lead > left + right).all(axis=1)
        if (more == sure).all():
            break
        sure = more
    at = np.flatnonzero(~sure)
    if not len(at):
        return tags
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | first[at[1:]]]))
    for lo, hi in zip(cut, np.append(cut[1:], len(at)), strict=True):
        a, b = at[lo], at[hi - 1] + 1
        part = e[a:b].astype(float).copy()
        if not first[a]:
            part[0] += t[OUT]
        if not last[b - 1]:
            part[-1] += t[:, OUT]
        tags[a:b] = viterbi(part, t)
    return tags


def _disguised(text: bytes, span: tuple[int, int, int, int, int]) -> tuple[bytes, int, int]:
    """The surroundings of a base span with another value in its place, and where that stands. The draw depends on the value alone."""
    _, start, end, vs, ve = span
    draw = hashlib.blake2b(text[vs:ve], digest_size=64).digest()
    alphabet = ALPHABETS[draw[0] % len(ALPHABETS)]
    value = bytes(alphabet[(draw[(i + 1) % 64] + 31 * i) % len(alphabet)] for i in range(max(20, min(64, ve - vs))))
    left = text[max(0, start - MARGIN) : start].rstrip() + b" "
    return left + value + b" " + text[end : end + MARGIN].lstrip(), len(left), len(left) + len(value)


def _windows(data: np.ndarray, offsets: np.ndarray, secrets: list[tuple[int, int, int]], plain: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Slots, tags and real tokens of windows around the secrets (row, start, end) of a batch, and, with ``plain``, of others."""
    starts, ends, rows = tokens(data, offsets)
    if not len(starts):
        return
    tags = np.zeros(len(starts), np.int64)
    for r, s, e in secrets:
        hit = np.flatnonzero((starts < offsets[r] + e) & (ends > offsets[r] + s) & (rows == r))
        if len(hit):
            tags[hit] = INSIDE
            tags[hit[0]] = BEGIN
    slots = features(data, starts, ends, rows, len(offsets) - 1)
    middle = np.flatnonzero(tags == BEGIN)
    step = max(SPAN, len(starts) // max(40, len(middle)))
    for c in np.concatenate([middle, np.arange(SPAN // 2, len(starts), step)]) if plain else middle:
        w = np.arange(c - SPAN // 2, c + SPAN // 2 + 1)
        ok = (w >= 0) & (w < len(starts))
        w = np.clip(w, 0, len(starts) - 1)
        ok &= rows[w] == rows[c]
        order = np.argsort(~ok, kind="stable")  # real tokens first
        w, ok = w[order], ok[order]
        yield slots[w], np.where(ok, tags[w], 0), ok


def _training_rows(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    data, offsets = K.text_bytes(b.column(0))
    for lo, hi in K.slices(offsets):
        part, off = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        secrets, hidden = [], []
        for r in _suspects(part, off):
            text = part[off[r] : off[r + 1]].tobytes()
            spans = base_spans(text)
            secrets += [(r, vs, ve) for _, _, _, vs, ve in spans]
            hidden += [_disguised(text, x) for x in spans if x[4] - x[3] >= DISGUISED_FROM]
        yield from _windows(part, off, secrets, True)
        if hidden:
            texts = pa.array([t for t, _, _ in hidden], pa.binary())
            yield from _windows(*K.text_bytes(texts), [(r, s, e) for r, (_, s, e) in enumerate(hidden)], False)


def train(docs: DataFrame, limit: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Fit on a sample by hash of doc_id of about ``limit`` documents; only the weights come to the driver. No documents: all
    weights are 0 and no span is added."""
    total = docs.count()
    share = min(1.0, limit / max(1, total))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20))).select("doc_id", "text").repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(5)), "doc_id", "text").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, plain = [], []
        for b in batches:
            for s, t, ok in _training_rows(b):
                (kept if t.any() else plain).append((s, t, ok))
        kept = kept[:WINDOWS]
        step = max(1, len(plain) // max(1, 2 * WINDOWS - len(kept)))
        kept += plain[::step][: 2 * WINDOWS - len(kept)]
        if kept:
            w, t = fit(*(np.stack(x) for x in zip(*kept, strict=True)))
            yield pa.RecordBatch.from_pydict({"w": [w.tobytes()], "t": [t.tobytes()]})

    got = sample.mapInArrow(run, "w binary, t binary").first()
    if not got:
        return np.zeros((SLOTS, 3), np.float32), np.zeros((3, 3), np.float32)
    return np.frombuffer(got[0], np.float32).reshape(SLOTS, 3), np.frombuffer(got[1], np.float32).reshape(3, 3)


def secret_spans(docs: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """The field learns from ``docs``, or from other documents. doc_id, the base counts and digest, ``spans`` (all spans as kind:start:end in code points, by start, then kind) and n_crf.

    Null texts are empty; an empty text has no spans; repeated rows have the same spans; other columns are ignored; an empty table
    gives no rows. Base spans always stay; a span of the field is added if no base span overlaps it."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs if learn_from is None else learn_from))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, t = held.value
        empty = hashlib.sha256(b"").hexdigest()
        for b in batches:
            data, offsets = K.text_bytes(b.column(1))
            n = b.num_rows
            counts = np.zeros((4, n), np.int64)
            digest, spans = [empty] * n, [""] * n
            for lo, hi in K.slices(offsets):
                part, off = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                found: dict[int, list[tuple[int, int, int]]] = {}
                for r in _suspects(part, off).tolist():
                    got = [(k, s, e) for k, s, e, _, _ in base_spans(part[off[r] : off[r + 1]].tobytes())]
                    if got:
                        found[r] = got
                starts, ends, rows = tokens(part, off)
                if len(starts):
                    slots = features(part, starts, ends, rows, hi - lo)
                    e = w[slots[:, 0]].copy()
                    for j in range(1, slots.shape[1]):
                        e += w[slots[:, j]]
                    tag = decode(e, rows, t)
                    live = np.flatnonzero(tag)
                    if len(live):
                        begin = np.concatenate([[True], (np.diff(live) > 1) | (tag[live[1:]] == BEGIN) | (rows[live[1:]] != rows[live[:-1]])])
                        first = np.flatnonzero(begin)
                        for i, j in zip(first, np.append(first[1:], len(live)) - 1, strict=True):
                            r = int(rows[live[i]])
                            s, x = int(starts[live[i]] - off[r]), int(ends[live[j]] - off[r])
                            if all(x <= s2 or s >= e2 for k, s2, e2 in found.get(r, []) if k < 3):
                                found.setdefault(r, []).append((3, s, x))
                for r, got in found.items():
                    raw = part[off[r] : off[r + 1]]
                    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                    text = [(int(points[s]), k, int(points[x])) for k, s, x in got]
                    text.sort()
                    for _, k, _ in text:
                        counts[k, lo + r] += 1
                    digest[lo + r] = hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{x}" for s, k, x in text if k < 3).encode()).hexdigest()
                    spans[lo + r] = ",".join(f"{KINDS[k]}:{s}:{x}" for s, k, x in text)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in counts[:3]), pa.array(digest), pa.array(spans), pa.array(counts[3])], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents``; for nulls, repeats and empty tables see ``secret_spans``."""
    return secret_spans(store.table(spark, sf_dir, "documents"))
