"""Word shingle sets as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
MAX_WORDS = 100_000  # some 15 MB in a worker


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _WordHashes()


def scramble(x: np.ndarray) -> np.ndarray:
    """Mix the bits of unsigned 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_list(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z in lower case; bytes know only ASCII case and white space."""
    return text.lower().split()


def shingle_hashes(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Hash of every run of ``width`` words, in order; of the whole sequence if it is
    shorter; none without words."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    span = min(width, n)
    out = np.full(n - span + 1, span, np.uint64)
    for k in range(span):
        out = out * _FACTOR + h[k:n - span + 1 + k]
    return scramble(out)


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingles of a whole text."""
    return np.unique(shingle_hashes(word_list(text), width))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())
