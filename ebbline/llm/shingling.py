"""Sets of word shingles, as hashes."""

from __future__ import annotations

import numpy as np
import xxhash

GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Hashes of the distinct shingles, sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    hashes, n = _hash_words(words), len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = mix(out * GOLD + hashes[i : i + n])
    return np.unique(out)
