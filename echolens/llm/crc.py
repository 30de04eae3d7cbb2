"""CRC-32 composition: the checksum of a joined text from its parts' checksums and lengths.

Appending ``n`` bytes to a text multiplies its checksum by ``x**(8n)`` modulo the checksum's polynomial, a linear
map of its 32 bits; so ``crc(a + b) = map(crc(a), len(b)) ^ crc(b)``, here for whole numpy columns at once.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np

POLYNOMIAL = 0xEDB88320     # fixed value: the reflected CRC-32 polynomial of zlib, gzip and zip


def _bits(images: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The linear map with ``images[k]`` as the image of bit k, applied to every ``x``."""
    out = np.zeros(len(x), np.uint32)
    for k in range(32):
        out ^= np.where(x >> np.uint32(k) & np.uint32(1), images[k], np.uint32(0))
    return out


@lru_cache(4096)
def _doubled(k: int) -> np.ndarray:
    """Images of the 32 bits when ``2**k`` zero bits are appended."""
    if k:
        half = _doubled(k - 1)
        return _bits(half, half)
    return np.array([POLYNOMIAL] + [1 << b for b in range(31)], np.uint32)


@lru_cache(4096)
def _by_byte(n: int) -> np.ndarray:
    """Four tables, one per byte of a checksum, whose XOR is the checksum after ``n`` more bytes."""
    images, k = np.array([1 << b for b in range(32)], np.uint32), 3
    while n:
        if n & 1:
            images = _bits(_doubled(k), images)
        n, k = n >> 1, k + 1
    byte = np.arange(256, dtype=np.uint32)
    return np.array([_bits(images, byte << np.uint32(8 * j)) for j in range(4)])


def combine(a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of the joined texts; ``length`` is the number of bytes of each second part."""
    out = np.empty(len(a), np.uint32)
    order = np.argsort(length, kind="stable")
    values, first = np.unique(length[order], return_index=True)
    for n, at in zip(values.tolist(), np.split(order, first[1:])):
        t, x = _by_byte(n), a[at]
        out[at] = t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]
    return out ^ b


SPACE = np.uint32(zlib.crc32(b" "))


def crc_sql(hexed: str) -> str:
    """CRC-32 of the bytes that ``hexed`` writes as hexadecimal digits, bit by bit."""
    digit = f"(instr('0123456789ABCDEF', substr({hexed}, {{}}, 1)) - 1)"
    byte = f"({digit.format('2 * i - 1')} * 16 + {digit.format('2 * i')})"
    bits = f"list_reduce(list_prepend(xor(c, v), range(8)), lambda b, k: xor(b >> 1, (b & 1) * {POLYNOMIAL}))"
    return (f"xor(list_reduce(list_prepend({0xFFFFFFFF}::BIGINT, list_transform(range(1, length({hexed}) // 2 + 1), lambda i: {byte}::BIGINT)), "
            f"lambda c, v: {bits}), {0xFFFFFFFF})")
