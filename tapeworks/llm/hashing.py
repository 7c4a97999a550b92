"""64-bit hashes of words and of runs of words, by numpy."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash

# Odd multipliers of the polynomial and the finaliser.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Bytes of a worker's word hashes, and of an entry besides its word.
CACHED = 16 << 20
ENTRY = 150


class WordHashes(dict):
    """Hash of a word, looked up where it was met before."""

    left = CACHED

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        self.left -= len(word) + ENTRY
        if self.left < 0:
            self.drop()
            self.left -= len(word) + ENTRY
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def drop(self) -> None:
        self.clear()
        self.left = CACHED


WORDS = WordHashes()


@contextmanager
def task_words() -> Iterator[WordHashes]:
    """The worker's word hashes, dropped when the task is done."""
    try:
        yield WORDS
    finally:
        WORDS.drop()


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * MIX_1
    values = (values ^ (values >> np.uint64(27))) * MIX_2
    return values ^ (values >> np.uint64(31))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    values = np.full(count, length, np.uint64)
    for i in range(length):
        values = values * BASE + hashes[i : i + count]
    return mix(values)


# Powers that are kept; those of longer texts are made for the text alone.
KEPT = 1 << 16


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    found = []
    for base in (int(BASE), pow(int(BASE), -1, 2**64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        found.append(np.multiply.accumulate(steps))
    return tuple(found)


_kept_powers = _powers(KEPT)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _kept_powers if n <= KEPT else _powers(n)


def stretches(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words from each ``begin`` up to its ``end``, independent of ``runs``."""
    up, down = _power(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes ^ MIX_1) * up[: len(hashes)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
