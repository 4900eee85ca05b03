"""Vectorised byte-string kernels used inside Spark tasks (numpy only, no Spark).

Bucket identifiers follow prefix doubling: the identifier of the 2m-gram at ``i`` is a
function of the identifiers of the m-grams at ``i`` and at the later offset ``i + m``.
"""

from __future__ import annotations

import numpy as np

# Odd multipliers of the 64-bit mixer (any odd constants do).
_MUL_LEFT = np.uint64(0x9E3779B97F4A7C15)
_MUL_RIGHT = np.uint64(0xC2B2AE3D27D4EB4F)


def _byte_ids() -> np.ndarray:
    """A fixed pseudo-random 64-bit identifier for each byte value."""
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MUL_LEFT
    for shift in (31, 27, 33):
        x ^= x >> np.uint64(shift)
        x *= _MUL_RIGHT
    return x


_BYTE_IDS = _byte_ids()


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Identifier of a pair of identifiers (order matters)."""
    out = right >> np.uint64(29)
    out ^= right
    out *= _MUL_RIGHT
    out += left * _MUL_LEFT
    t = out >> np.uint64(32)
    out ^= t
    return out


def gram_ids(buf: np.ndarray, q: int) -> np.ndarray:
    """64-bit bucket identifiers of all q-grams of ``buf`` (uint8), by doubling."""
    if len(buf) < q:
        return np.empty(0, np.uint64)
    ids, m = _BYTE_IDS[buf], 1
    while 2 * m <= q:
        ids = _pair(ids[:-m], ids[m:])
        m *= 2
    if m < q:
        ids = _pair(ids[: len(buf) - q + 1], ids[q - m:])
    return ids


def window_argmin(ids: np.ndarray, w: int) -> np.ndarray:
    """For each window of ``w`` identifiers, the index of the smallest (by its upper 40
    bits); the rightmost of equals.  ``len(ids)`` must stay below 2**24."""
    if len(ids) >= 1 << 24:
        raise ValueError("window_argmin takes fewer than 2**24 identifiers at a time")
    if len(ids) < w:
        return np.empty(0, np.int64)
    low = np.uint64((1 << 24) - 1)
    key = (ids & ~low) | (low - np.arange(len(ids), dtype=np.uint64))
    n, m = len(ids) - w + 1, 1
    while 2 * m <= w:
        key = np.minimum(key[:-m], key[m:])
        m *= 2
    if m < w:
        key = np.minimum(key[:n], key[w - m: w - m + n])
    return (low - (key & low)).astype(np.int64)


def gram_ids_pair(buf: np.ndarray, q: int, wider: int) -> tuple[np.ndarray, np.ndarray]:
    """``gram_ids`` for two lengths, ``q <= wider``, sharing the doubling rounds."""
    short = np.empty(0, np.uint64)
    if len(buf) < q:
        return short, short
    ids, m, first = _BYTE_IDS[buf], 1, None
    while True:
        if first is None and 2 * m > q:
            first = ids if m == q else _pair(ids[: len(buf) - q + 1], ids[q - m:])
            if len(buf) < wider:
                return first, short
        if 2 * m > wider:
            return first, ids if m == wider else _pair(ids[: len(buf) - wider + 1], ids[wider - m:])
        ids = _pair(ids[:-m], ids[m:])
        m *= 2
