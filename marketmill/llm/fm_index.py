"""A compressed full-text index in numpy: a wavelet matrix over a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks in a sequence of whole numbers, one bit array for each bit of a number."""

    def __init__(self, values: np.ndarray, top: int):
        self.bits, self.before, self.zeros = [], [], []
        now = values
        self.levels = max(1, int(top).bit_length())
        starts = np.zeros(top + 1, dtype=np.int64)
        every = np.arange(top + 1)
        for level in range(self.levels - 1, -1, -1):
            ones = (now >> level) & 1 == 1
            padded = np.zeros((len(ones) // 64 + 1) * 64, dtype=bool)
            padded[: len(ones)] = ones
            words = np.packbits(padded.reshape(-1, 64), axis=1, bitorder="little").view(np.uint64)
            self.bits.append(words.ravel())
            counts = np.bitwise_count(self.bits[-1]).astype(np.int64)
            self.before.append(np.cumsum(counts) - counts)
            self.zeros.append(int(len(ones) - ones.sum()))
            now = np.concatenate([now[~ones], now[ones]])
            starts = self.step(len(self.bits) - 1, (every >> level) & 1 == 1, starts)
        self.starts = starts

    def step(self, level: int, ones: np.ndarray, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.bits[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        rank = self.before[level][word] + np.bitwise_count(low)
        return np.where(ones, rank + self.zeros[level], at - rank)

    def rank(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value is met before each place."""
        first = self.starts[values]
        for level in range(self.levels):
            ones = (values >> (self.levels - 1 - level)) & 1 == 1
            at = self.step(level, ones, at)
        return at - first


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` symbols or more, by doubling.

    The first keys hold as many symbols as 63 bits take.
    """
    width = max(1, int(symbols.max()).bit_length()) if len(symbols) else 1
    reach = max(1, min(63 // width, depth))
    keys = np.zeros(len(symbols), dtype=np.int64)
    for at in range(reach):
        keys <<= width
        keys[: len(symbols) - at] |= symbols[at:]
    order = np.argsort(keys, kind="stable")
    ranks = np.zeros(len(symbols), dtype=np.int64)
    ranks[order[1:]] = np.cumsum(keys[order][1:] != keys[order][:-1])
    while reach < depth:
        after = np.zeros(len(ranks), dtype=np.int64)
        after[:-reach] = ranks[reach:] + 1
        pair = ranks * (len(ranks) + 1) + after
        order = np.argsort(pair, kind="stable")
        sorted_pair = pair[order]
        fresh = np.empty(len(ranks), dtype=np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(sorted_pair[1:] != sorted_pair[:-1])])
        ranks = fresh
        reach *= 2
        if len(ranks) and ranks.max() == len(ranks) - 1:
            break
    return order


class FMIndex:
    """Index of `symbols` (0 separates texts) for patterns of up to `depth` symbols.

    `weights` says how many times each symbol's text is met.
    """

    def __init__(self, symbols: np.ndarray, depth: int, weights: np.ndarray):
        self.order = suffix_order(symbols, depth + 1)
        self.met = np.concatenate([[0], np.cumsum(weights[self.order])])
        self.place = np.empty(len(symbols), dtype=np.int64)  # of each suffix in the order
        self.place[self.order] = np.arange(len(symbols))
        transform = symbols[self.order - 1]
        top = int(symbols.max()) if len(symbols) else 0
        counts = np.bincount(symbols, minlength=top + 1)
        self.first = np.cumsum(counts) - counts
        self.matrix = WaveletMatrix(transform, top)

    def matches(
        self, symbols: np.ndarray, ends: np.ndarray, depth: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics by backward search, from each end on, up to `depth` symbols.

        Returns for each end how many symbols before it are also met elsewhere, copies of a
        text counted, and the range of the suffixes that start with them. `symbols` must be
        indexed here, so every search finds itself; it stops when it finds nothing else. A
        range of one suffix is the search's own text: where its copies are all there is, all
        `depth` symbols are met again and the range is known.
        """
        length = np.zeros(len(ends), dtype=np.int64)
        low = np.zeros(len(ends), dtype=np.int64)
        high = np.full(len(ends), len(self.order), dtype=np.int64)
        active = np.arange(len(ends))
        for back in range(1, depth + 1):
            symbol = symbols[ends[active] - back]
            first = self.first[symbol]
            new_low = first + self.matrix.rank(symbol, low[active])
            new_high = first + self.matrix.rank(symbol, high[active])
            more = self.met[new_high] - self.met[new_low] > 1
            active = active[more]
            low[active], high[active] = new_low[more], new_high[more]
            length[active] = back
            single = high[active] - low[active] == 1
            own = active[single]
            length[own] = depth
            low[own] = self.place[ends[own] - depth]
            high[own] = low[own] + 1
            active = active[~single]
            if not len(active):
                break
        return length, low, high
