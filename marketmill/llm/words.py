"""Hashes of words and of runs of words, in numpy."""

from __future__ import annotations

import numpy as np

FACTOR = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def spread(x: np.ndarray) -> np.ndarray:
    """Mixes 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A random value for each byte, zero for white space; powers of FACTOR by place in a word.
BYTES = np.where(SPACE, np.uint64(0), spread(np.arange(1, 257, dtype=np.uint64) * FACTOR))
POWERS = np.cumprod(np.full(64, FACTOR, dtype=np.uint64))


def word_starts(text: bytes) -> np.ndarray:
    """Where the runs of bytes without ASCII white space begin."""
    inside = ~SPACE[np.frombuffer(text, dtype=np.uint8)]
    inside[1:] &= ~inside[:-1]
    return np.flatnonzero(inside)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each run of bytes without ASCII white space."""
    starts = word_starts(text)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    values = np.frombuffer(text, dtype=np.uint8)[starts[0] :]
    sizes = np.diff(starts, append=len(text))
    place = np.arange(len(values)) - np.repeat(starts - starts[0], sizes)
    longest = int(sizes.max())
    powers = POWERS
    if longest > len(powers):
        powers = np.cumprod(np.full(longest, FACTOR, dtype=np.uint64))
    return spread(np.add.reduceat(BYTES[values] * powers[place], starts - starts[0]))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` words; none if there are fewer."""
    count = max(len(words) - size + 1, 0)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(size if count else 0):
        total = (total + words[i : i + count]) * FACTOR
    return spread(total)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of `width` values, by doubling."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = np.minimum(values[: len(values) - step], values[step:])
        reach += step
    return values
