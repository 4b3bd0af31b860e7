"""Word shingles of a text as sorted 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

_MOST_WORDS = 100_000
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_S33 = np.uint64(33)


class _Words(dict):
    """Word to hash; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


WORDS = _Words()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Distinct shingles of ``size`` words, sorted. A-Z are lower-cased, words are split at
    ASCII white space. With fewer words the whole sequence is one shingle; without a word
    the set is empty."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total = mix(total * _STEP + h[i : len(h) - size + 1 + i])
    return np.unique(total)


def set_key(hashes: np.ndarray) -> bytes:
    """A 128-bit name of a set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def jaccard_at_least(a: int, b: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)
