"""Words and runs of words of whole texts as 64-bit numbers."""

from __future__ import annotations

import numpy as np
import xxhash

from siftworks.llm.chains import mixed

_STEP = np.uint64(0xD6E8FEB86659FD93)


class WordNumbers(dict):
    """A 64-bit hash of every word; keeps those of late at hand."""

    def __init__(self, kept: int = 200_000) -> None:
        super().__init__()
        self.kept = kept

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.kept:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def runs(numbers: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of every ``size`` consecutive numbers."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, seed, np.uint64)
    for i in range(size):
        out = (out ^ numbers[i:i + n]) * _STEP
        out ^= out >> np.uint64(31)
    return mixed(out)


def shingle_set(numbers: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct runs of ``size`` words; the whole sequence if there are fewer."""
    if not len(numbers):
        return np.zeros(0, np.uint64)
    return np.unique(runs(numbers, min(size, len(numbers)), size if len(numbers) >= size else 0))
