"""Word-shingle sets of whole texts as sorted 64-bit hashes (numpy, no per-word Python)."""

from __future__ import annotations

import numpy as np

from .base import mix64

SEGMENT = 1 << 20      # bytes hashed at a time, cut at white space
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int):
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS["up"]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, b in (("up", _BASE), ("down", inverse)):
            x = np.full(max(n, 1 << 16), b, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


def _segment_hashes(b: np.ndarray, space: np.ndarray) -> np.ndarray:
    up, down = _powers(len(b))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[b] * up[:len(b)], dtype=np.uint64)))
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word (A-Z lower-cased), in order; equal words hash alike in every text."""
    if not text:
        return np.zeros(0, np.uint64)
    b = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    space = _SPACE[b]
    if len(b) <= SEGMENT:
        return _segment_hashes(b, space)
    gaps, parts, at = np.flatnonzero(space), [], 0
    while at < len(b):
        k = np.searchsorted(gaps, at + SEGMENT)
        end = int(gaps[k]) if k < len(gaps) else len(b)
        parts.append(_segment_hashes(b[at:end], space[at:end]))
        at = end if end > at else end + 1
    return np.concatenate(parts)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's ``words``-word shingles.

    A text of fewer words is one shingle, its whole sequence; without words the set is empty.
    """
    w = word_hashes(text)
    if not len(w):
        return w
    n = max(1, len(w) - words + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(words, len(w))):
        h = mix64(h * np.uint64(0xD6E8FEB86659FD93) + w[i:i + n])
    return np.unique(h)
