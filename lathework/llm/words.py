"""Words, their numbers, and runs of words, shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import xxhash

#: A maximal run of letters, digits and underscores; texts are lowered first.
WORD = re.compile(r"\w+")

_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURN = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class WordNumbers(dict):
    """64-bit numbers of words, equal in every process; emptied when grown to ``most`` entries."""

    def __init__(self, most: int = 400_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        number = xxhash.xxh64_intdigest(word)
        if len(self) >= self.most:
            self.clear()
        self[word] = number
        return number


def numbers(words: Iterable[str], table: WordNumbers) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), dtype=np.uint64)


def scatter(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that near values fall far apart."""
    x = values ^ (values >> np.uint64(30))
    x = x * _TURN[0]
    x ^= x >> np.uint64(27)
    x = x * _TURN[1]
    return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive values; empty when there are fewer."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            total = scatter(total * _MIX + values[i : i + n])
    return total
