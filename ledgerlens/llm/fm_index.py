"""FM-index over a sequence of small integers, with vectorised queries."""

from __future__ import annotations

import numpy as np


def suffix_array(t: np.ndarray, sigma: int) -> np.ndarray:
    """Order of all suffixes of ``t`` (values below ``sigma``); the end sorts lowest.

    The first pass sorts by as many symbols as fit in one integer; later passes double the
    length and touch only suffixes that still tie.
    """
    n = len(t)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    bits = int(sigma).bit_length()  # one value more: past the end
    width = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    for j in range(width):
        key <<= bits
        if j < n:
            key[: n - j] |= t[j:] + 1
    sa = np.argsort(key)
    key = key[sa]
    head = np.ones(n, dtype=bool)
    head[1:] = key[1:] != key[:-1]
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    single = head.copy()
    single[:-1] &= head[1:]
    place = np.flatnonzero(~single)
    k = width
    while len(place):
        suffix = sa[place]
        after = np.zeros(len(place), dtype=np.int64)
        inside = suffix + k < n
        after[inside] = rank[suffix[inside] + k] + 1
        key = rank[suffix] * (n + 1) + after
        order = np.argsort(key)
        suffix, key = suffix[order], key[order]
        sa[place] = suffix
        head = np.ones(len(place), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        rank[suffix] = place[np.maximum.accumulate(np.where(head, np.arange(len(place)), 0))]
        single = head.copy()
        single[:-1] &= head[1:]
        place = place[~single]
        k *= 2
    return sa


class BitRank:
    """A bit sequence with counts of ones before any place."""

    def __init__(self, bits: np.ndarray):
        words = len(bits) // 64 + 1
        packed = np.zeros(words * 8, dtype=np.uint8)
        small = np.packbits(bits, bitorder="little")
        packed[: len(small)] = small
        self.words = packed.view(np.uint64)
        self.before = np.zeros(words, dtype=np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:], dtype=np.int32)
        self.zeros = len(bits) - int(np.count_nonzero(bits))

    def ones(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletTree:
    """Ranks of symbols in a sequence; the nodes of a level lie side by side in one bit sequence."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.levels = []
        for b in range(self.bits - 1, -1, -1):
            ones = (sequence >> b) & 1 == 1
            self.levels.append(BitRank(ones))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before place ``i``, element by element."""
        start = np.zeros(len(i), dtype=np.int64)
        for b, level in zip(range(self.bits - 1, -1, -1), self.levels):
            one = (symbol >> b) & 1 == 1
            at, first = level.ones(i), level.ones(start)
            i = np.where(one, level.zeros + at, i - at)
            start = np.where(one, level.zeros + first, start - first)
        return i - start

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place ``i`` and its occurrences before it."""
        symbol = np.zeros(len(i), dtype=np.int64)
        start = np.zeros(len(i), dtype=np.int64)
        for level in self.levels:
            one = level.at(i)
            at, first = level.ones(i), level.ones(start)
            i = np.where(one, level.zeros + at, i - at)
            start = np.where(one, level.zeros + first, start - first)
            symbol = symbol * 2 + one
        return symbol, i - start


class FMIndex:
    """Full-text index of ``t``: counts and places of any pattern.

    Built from the Burrows-Wheeler transform in a wavelet tree and every ``sample``-th suffix
    position.  An end of its own, lower than every symbol, follows ``t``.
    """

    def __init__(self, t: np.ndarray, sigma: int, sample: int = 16):
        # Suffix 0 comes after the end only, which occurs once: steps back keep their order.
        t, sigma = np.append(t + 1, 0), sigma + 1
        sa = suffix_array(t, sigma)
        self.n, self.sigma = len(t), sigma
        self.tree = WaveletTree(t[sa - 1], sigma)
        self.smaller = np.zeros(sigma + 1, dtype=np.int64)
        np.cumsum(np.bincount(t, minlength=sigma), out=self.smaller[1:])
        kept = sa % sample == 0
        self.kept = BitRank(kept)
        self.position = sa[kept]

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that start with each pattern (rows of a padded matrix)."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        alive = np.arange(len(patterns))
        for step in range(int(lengths.max(initial=0))):
            alive = alive[(low[alive] < high[alive]) & (lengths[alive] > step)]
            if not len(alive):
                break
            c = patterns[alive, lengths[alive] - 1 - step] + 1
            low[alive] = self.smaller[c] + self.tree.rank(c, low[alive])
            high[alive] = self.smaller[c] + self.tree.rank(c, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Suffix positions of rows, by steps back to the next sampled one."""
        out = np.zeros(len(rows), dtype=np.int64)
        open_, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            found = self.kept.at(rows)
            out[open_[found]] = self.position[self.kept.ones(rows[found])] + steps
            open_, rows = open_[~found], rows[~found]
            c, before = self.tree.symbol_and_rank(rows)
            rows = self.smaller[c] + before
            steps += 1
        return out
