"""Weighted word shingles of many texts, as flat arrays."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORDS = re.compile(r"[^ \t-\r]+")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
CACHE_ENTRIES = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the fixed constants of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash by word; bounded by ``trim``."""

    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found

    def trim(self) -> None:
        if len(self) > CACHE_ENTRIES:
            self.clear()


def shingles(text: str, width: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of ``width`` lower-case words, ascending by hash, and how often each occurs.

    A text of fewer words has one shingle of all of them; one without words has none.
    """
    words = WORDS.findall(text.lower())
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(width, n)
    mixed = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        mixed = mix(mixed + GOLDEN ^ own[k:n - width + 1 + k])
    return np.unique(mixed, return_counts=True)
