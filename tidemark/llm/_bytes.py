"""Vectorised text primitives on UTF-8 buffers, used inside Spark tasks.

Everything works on slices of a megabyte: an Arrow batch is cut into runs
of whole texts (``slices``), so a task's memory does not depend on the batch.
Hashes are 64-bit polynomials over random odd tables; all tables come from one
fixed seed, so every task of every run computes the same values.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_RNG = np.random.default_rng(20260601)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD1342543DE82EF95)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = True
_ALNUM[97:123] = True
_ALNUM[128:] = True


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    big = pa.large_binary()
    col = col.cast(pa.large_string()).cast(big) if pa.types.is_string(col.type) else col.cast(big)
    n = len(col)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64, count=n + 1 + col.offset)[col.offset:] if n else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if n and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    if col.null_count:
        keep = np.where(col.is_null().to_numpy(zero_copy_only=False), 0, np.diff(off))
        new = np.concatenate([[0], np.cumsum(keep)])
        parts = [data[off[i]:off[i + 1]] for i in np.flatnonzero(keep)]
        data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        return data, new.astype(np.int64)
    base = off[0]
    return data[base:off[-1]], off - base


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of whole texts, each of at most ``limit`` bytes or one text."""
    a, n = 0, len(off) - 1
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def words(data: np.ndarray, off: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a slice: hash, start, end (byte positions) and text index.

    kind "space": runs of non-white-space bytes; "alnum": runs of ASCII digits,
    letters and non-ASCII bytes. A-Z is lower-cased for the hash. A word never
    crosses two texts.
    """
    low = _LOWER[data]
    inside = ~_SPACE[low] if kind == "space" else _ALNUM[low]
    n = len(low)
    empty = np.zeros(0, np.int64)
    if n == 0 or not inside.any():
        return np.zeros(0, np.uint64), empty, empty, empty
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = off[:-1][off[:-1] < n]
    begin[heads] |= inside[heads]
    starts = np.flatnonzero(begin)
    owner = np.searchsorted(off, starts, side="right") - 1
    # the word ends at the first byte outside it, or where the text or next word begins
    where = np.flatnonzero(inside)
    rank = np.searchsorted(where, starts)
    length = np.diff(np.append(rank, len(where)))
    ends = starts + length
    place = np.arange(len(where)) - np.repeat(rank, length)
    h = np.add.reduceat(_BYTE[low[where]] * powers(_BASE, int(length.max()))[place], rank)
    return mix(h + length.astype(np.uint64)), starts, ends, owner


def run_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries of h (len(h)-k+1 values)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(k):
        out = out * _STEP + h[j:j + m]
    return mix(out)


def sequence_hash(h: np.ndarray) -> int:
    """Hash of a whole short sequence (with its length)."""
    out = np.uint64(0)
    with np.errstate(over="ignore"):
        for x in h:
            out = out * _STEP + x
        return int(mix(np.array([out + np.uint64(len(h)) * _BASE], dtype=np.uint64))[0])


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
