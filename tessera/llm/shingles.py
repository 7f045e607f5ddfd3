"""Sets of hashed word shingles of whole texts, with NumPy only."""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np

from tessera.llm.common import kept_store

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
#: Words of more bytes are hashed one by one: polynomials of whole words of a thousand
#: bytes or more can be made to collide.
_LONG = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


kept_store(_powers.cache_clear)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of a lower-cased text's words, in order."""
    if not text:
        return np.zeros(0, np.uint64)
    b = np.frombuffer(text.lower(), np.uint8)
    space = _SPACE[b]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(1 << max(16, len(b).bit_length()))
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum((b + np.uint64(1)) * up[: len(b)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    h = mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(end - start > _LONG).tolist():
        word = b[start[i] : end[i]].tobytes()
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=b"long word").digest(), "little")
    return h


def shingle_set(text: bytes, words: int = 5) -> np.ndarray:
    """Distinct hashed shingles, sorted: of `words` words, or of all there are if fewer;
    none without words."""
    w = word_hashes(text)
    n = len(w)
    if not n:
        return w
    k = min(words, n)
    total = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        total = total * np.uint64(_BASE) + w[j : n - k + 1 + j]
    return np.unique(mix(total))
