"""Vectorised text kernels shared by the corpus operators.

Every kernel works on one Arrow batch inside a task: UTF-8 bytes plus offsets, no per-word Python.  Words are the runs of
bytes outside ``\\x20 \\x09-\\x0D``; hashes are 64-bit, taken from prefix sums of an odd-base polynomial (so the hash of any
byte range is two look-ups) and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
BLOCK = 1 << 18

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: A second base, for a second hash of the same bytes.
OTHER_BASE = 0xD1342543DE82EF95

_pow: dict[int, list[np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if base not in _pow or len(_pow[base][0]) < n:
        size = max(n, BLOCK + 4096)
        _pow[base] = [np.concatenate([np.ones(1, U64), np.cumprod(np.full(size, b, U64))]) for b in (base, pow(base, -1, 1 << 64))]
    return _pow[base]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary Arrow column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def _cuts(space: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about BLOCK bytes that end at white space; a longer word stays whole."""
    lo, n = 0, len(space)
    while lo < n:
        hi = lo + BLOCK
        if hi < n:
            back = np.flatnonzero(space[lo:hi])
            if len(back):
                hi = lo + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(space[hi:])
                hi = hi + int(ahead[0]) + 1 if len(ahead) else n
        yield lo, min(hi, n)
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; words never cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Mixed 64-bit hash of each byte range; equal bytes give equal hashes wherever they stand."""
    out = np.empty(len(starts), U64)
    lo = 0
    while lo < len(starts):  # ranges are sorted by start: take as many as fit in a block
        at = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(starts, at + BLOCK, "left")))
        top = int(ends[lo:hi].max())
        p, inv = powers(top - at + 1, base)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum((data[at:top].astype(U64) + U64(1)) * p[: top - at])])
        out[lo:hi] = (sums[ends[lo:hi] - at] - sums[starts[lo:hi] - at]) * inv[starts[lo:hi] - at]
        lo = hi
    return mix(out ^ (ends - starts).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, number of the first word of each row (rows + 1 values), and the words' first bytes."""
    starts, ends = word_bounds(data, offsets)
    return range_hashes(LOWER[data] if lower else data, starts, ends), np.searchsorted(starts, offsets), starts


_STEP = list(mix(np.arange(1, 65, dtype=U64) * U64(_BASE)) | U64(1))


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of k words and its row; a row of 1 to k - 1 words is one window as a whole."""
    counts = np.diff(first)
    n = len(hashes)
    rows = np.repeat(np.arange(len(counts)), counts)
    sums = np.zeros(max(0, n - k + 1), U64)
    for j in range(k):
        sums += hashes[j : n - k + 1 + j] * _STEP[j]
    ok = rows[: len(sums)] == rows[k - 1 :] if len(sums) else np.zeros(0, bool)
    out, at = mix(sums[ok]), rows[: len(sums)][ok]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.array([sum((int(hashes[first[r] + j]) * int(_STEP[j]) for j in range(counts[r])), int(counts[r]) + 1) % (1 << 64) for r in short], U64)
        out, at = np.concatenate([out, mix(extra)]), np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        out, at = out[order], at[order]
    return out, at


def distinct(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values within each row, sorted by row, then value."""
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    return v[keep], r[keep]


def fnv(text: str) -> int:
    """Hash of one word as ``words`` gives it, for tests and small dictionaries."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return int(range_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
