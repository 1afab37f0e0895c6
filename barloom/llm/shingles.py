"""Hashed word shingles of whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
CACHED_WORDS = 100_000
_MULTIPLIERS = np.array([xxhash.xxh64_intdigest(b"place", i) | 1 for i in range(WORDS)], np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all 64 bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes.

    Words are runs without ASCII white space, A-Z lower-cased. A shingle is five words; a
    text with fewer has its whole sequence as the one shingle; without words there is none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_HASHES) > CACHED_WORDS:
        _HASHES.clear()
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total += hashes[i : i + count] * _MULTIPLIERS[i]
    return np.unique(mixed(total))
