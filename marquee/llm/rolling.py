"""Rabin-Karp fingerprints in numpy: polynomial hashes modulo 2^64 from prefix sums.

The hash of values[i:j] is (prefix[j] - prefix[i]) / base^i, so all n-grams of a sequence cost one
subtraction and one product each.  Bytes are hashed to words, and words to n-grams.
"""

from __future__ import annotations

import numpy as np

#: Odd bases of the polynomials, over bytes and over words.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Bytes whose words are hashed at once.
SEGMENT = 1 << 20


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, kept as far as they were needed."""

    def __init__(self, base: int):
        self.steps = np.array([base, pow(base, -1, 1 << 64)], np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            grown = []
            for step in self.steps:
                row = np.full(max(n, 1 << 16), step, np.uint64)
                row[0] = 1
                grown.append(np.multiply.accumulate(row))
            self.up, self.down = grown
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = Powers(BYTE_BASE), Powers(WORD_BASE)


def scrambled(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def between(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, powers: Powers) -> np.ndarray:
    """Polynomial hashes of values[start:stop], from the prefix sums of the polynomial."""
    up, down = powers.to(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=prefix[1:])
    return (prefix[stops] - prefix[starts]) * down[starts]


def words_between(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of every run that is no gap."""
    edge = np.ones(len(gap) + 2, bool)
    edge[1:-1] = gap
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    return turns[::2], turns[1::2]


def word_values(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word, by segments of the chunk that end with a word."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + SEGMENT, "right")))
        a = starts[i]
        values = raw[a:stops[j - 1]].astype(np.uint64) + np.uint64(1)
        out[i:j] = between(values, starts[i:j] - a, stops[i:j] - a, _BYTES)
        i = j
    return scrambled(out)


def word_ngrams(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Fingerprints of the words [start, stop), not yet scrambled."""
    return between(values, starts, stops, _WORDS)
