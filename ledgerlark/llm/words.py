"""Hashes of words and of word shingles, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
_CACHED = 100_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters neighbouring values."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class WordHashes(dict):
    """64-bit hash of each word, computed once while the word is held."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(text: bytes | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased: separated by space and the codes 9 to 13."""
    return text.lower().split() if text else []


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter, non-empty
    sequence is one shingle."""
    width = min(size, len(hashes))
    if not width:
        return np.empty(0, np.uint64)
    count = len(hashes) - width + 1
    value = np.full(count, width, np.uint64)
    for k in range(width):
        value = mix(value * _ODD + hashes[k:k + count])
    return np.unique(value)
