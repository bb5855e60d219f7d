"""Hashes of words and of runs of words, the same in every process."""

from __future__ import annotations

import numpy as np
import xxhash


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    LIMIT = 1 << 16

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words, in order."""
    n = len(hashes) - k + 1
    total = np.zeros(max(0, n), dtype=np.uint64)
    for i in range(k if n > 0 else 0):
        total = mixed(total + hashes[i : n + i])
    return total


def shingle_set(words: list[bytes], k: int, memo: WordHashes) -> np.ndarray:
    """The sorted hashes of the distinct runs of k words; of fewer words, their whole sequence is the one shingle."""
    if len(words) >= k:
        return np.unique(runs(memo.of(words), k))
    return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=k)] if words else [], dtype=np.uint64)
