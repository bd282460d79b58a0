"""Suffix arrays with common-prefix values by induced sorting.

The suffixes that are smaller than both neighbours (S*) are sorted first, by naming their
substrings and recursion; all others are induced from them in two scans.  Both scans run
over a priority queue of suffix tuples (position, common prefix with the tuple before) that
keeps one sequence per first symbol, in memory or on disk, and are vectorised symbol by symbol.
"""

from __future__ import annotations

import tempfile

import numpy as np

from ledgerlens.llm.fm_index import suffix_array

#: Reduced strings of at most this many names are sorted in memory, longer ones by recursion.
BASE = 1 << 22
#: Bytes of tuples that a queue holds in memory.
MEMORY = 96 << 20


class SuffixQueue:
    """Tuples by first symbol, in the order they came in; the excess lies on disk."""

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.spilled: dict[int, list[tuple[int, int]]] = {}
        self.file = None

    def push(self, symbol: int, position: np.ndarray, lcp: np.ndarray) -> None:
        self.parts.setdefault(symbol, []).append((position, lcp))
        self.held += position.nbytes + lcp.nbytes
        if self.held > self.memory:
            self.spill()

    def spill(self) -> None:
        """Append all sequences to the worker's own scratch file, which closes with the queue."""
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for symbol, parts in self.parts.items():
            position, lcp = (np.concatenate(x) for x in zip(*parts))
            self.spilled.setdefault(symbol, []).append((self.file.seek(0, 2), len(position)))
            self.file.write(position.tobytes())
            self.file.write(lcp.tobytes())
        self.parts, self.held = {}, 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All tuples of a symbol that came in since the last call."""
        found = []
        for at, n in self.spilled.pop(symbol, ()):
            self.file.seek(at)
            found.append((np.frombuffer(self.file.read(4 * n), np.int32), np.frombuffer(self.file.read(n), np.uint8)))
        for position, lcp in self.parts.pop(symbol, ()):
            self.held -= position.nbytes + lcp.nbytes
            found.append((position, lcp))
        if not found:
            return None
        return found[0] if len(found) == 1 else tuple(np.concatenate(x) for x in zip(*found))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that follows (type S); the last one is."""
    n = len(t)
    change = np.flatnonzero(t[:-1] != t[1:])
    out = np.ones(n, dtype=bool)
    if len(change):
        # A suffix is like the last one of its run of equal symbols.
        run = np.searchsorted(change, np.arange(change[-1] + 1))
        out[: change[-1] + 1] = (t[change] < t[change + 1])[run]
    return out


def starred(s_type: np.ndarray) -> np.ndarray:
    return np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1


def names_of(t: np.ndarray, star: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """Ranks of the substrings from each S* position to the next, and how many differ.

    Sorted by a few symbols at a time; only substrings that tie and go on are sorted further.
    A substring that ends is larger than one that goes on with a suffix of type L there.
    """
    m = len(star)
    length = np.diff(np.append(star, star[-1])) + 1
    length[-1] = 1
    width = 62 // (bits + 1)
    high = 1 << bits
    order, rank = np.arange(m), np.zeros(m, dtype=np.int64)
    place, group = np.arange(m), np.zeros(m, dtype=np.int64)
    done = 0
    while len(place):
        own = order[place]
        key = np.zeros(len(own), dtype=np.int64)
        for k in range(done, done + width):
            inside = k < length[own]
            key = (key << (bits + 1)) | np.where(inside, t[np.where(inside, star[own] + k, 0)], high)
        # Groups are runs of places; sort within them.
        by = np.lexsort((key, group)) if done else np.argsort(key, kind="stable")
        own, key, group = own[by], key[by], group[by]
        order[place] = own
        head = np.ones(len(own), dtype=bool)
        head[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        first = np.maximum.accumulate(np.where(head, np.arange(len(own)), 0))
        rank[own] = place[first]
        done += width
        single = head.copy()
        single[:-1] &= head[1:]
        on = ~single & (length[own] > done)
        place, group = place[on], place[first][on]
    values, dense = np.unique(rank, return_inverse=True)
    return dense.astype(np.int64), len(values)


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common symbols of suffixes ``a`` and ``b``, at most ``cap``; ``words`` packs four symbols."""
    out = np.full(len(a), cap, dtype=np.int64)
    on = np.arange(len(a))
    top = len(words) - 1
    for k in range(0, cap, 4):
        x = words[np.minimum(a[on] + k, top)] ^ words[np.minimum(b[on] + k, top)]
        apart = x != 0
        low = x[apart]
        low = low & (~low + np.uint64(1))
        out[on[apart]] = np.minimum(k + (np.bitwise_count(low - np.uint64(1)) >> 4), cap)
        on = on[~apart]
        if not len(on):
            break
    return out


class Scan:
    """One of the two scans: takes suffixes in order and queues those they induce."""

    def __init__(self, t: np.ndarray, wanted: np.ndarray, symbols: int, cap: int, queue: SuffixQueue):
        self.t, self.wanted, self.cap, self.queue = t, wanted, cap, queue
        # Smallest common prefix since the last tuple queued for a symbol.
        self.since = np.zeros(symbols if cap else 0, dtype=np.uint8)

    def feed(self, position: np.ndarray, lcp: np.ndarray) -> None:
        before = position - 1
        index = np.flatnonzero((before >= 0) & self.wanted[before])
        symbol = self.t[before[index]]
        by = np.argsort(symbol, kind="stable")
        index, symbol = index[by], symbol[by]
        cut = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]])) if len(symbol) else []
        ends = np.append(cut[1:], len(symbol)) if len(symbol) else []
        if self.cap:
            after = {}
            padded = np.append(lcp, np.uint8(self.cap))
            for a, b in zip(cut, ends):
                s, p = int(symbol[a]), index[a:b]
                least = np.minimum.reduceat(padded, np.concatenate([[0], p + 1]))
                least[0] = min(least[0], self.since[s])
                own = np.minimum(least[:-1] + np.uint8(1), self.cap).astype(np.uint8)
                self.queue.push(s, before[p], own)
                after[s] = least[-1]
            np.minimum(self.since, lcp.min(), out=self.since)
            for s, x in after.items():
                self.since[s] = x
        else:
            for a, b in zip(cut, ends):
                p = index[a:b]
                self.queue.push(int(symbol[a]), before[p], np.zeros(len(p), np.uint8))


def induced_suffix_array(
    t: np.ndarray, cap: int = 0, base: int = BASE, memory: int = MEMORY
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``t`` in order, and each one's common prefix with the one before, up to ``cap``.

    ``t`` holds integers of 0 or more (below 2 ** 14 if ``cap`` is given) and ends with its only 0.
    With ``cap`` 0 there are no common prefixes.
    """
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32), np.zeros(1, np.uint8)
    t = t.astype(np.uint16) if cap else t
    s_type = smaller_than_next(t)
    star = starred(s_type).astype(np.int32)
    bits = max(1, int(t.max()).bit_length())
    name, distinct = names_of(t, star, bits)
    if distinct == len(star):
        order = np.argsort(name)
    elif len(star) <= base:
        order = suffix_array(name, distinct)
    else:
        order = induced_suffix_array(name, 0, base, memory)[0]
    star = star[order]
    if cap:
        long = np.concatenate([t, np.zeros(4, t.dtype)]).astype(np.uint64)
        words = long[:n] | long[1 : n + 1] << np.uint64(16) | long[2 : n + 2] << np.uint64(32) | long[3 : n + 3] << np.uint64(48)
        star_lcp = np.zeros(len(star), np.uint8)
        star_lcp[1:] = common_prefix(words, star[:-1], star[1:], cap)
    else:
        words, star_lcp = None, np.zeros(len(star), np.uint8)

    def joint(a: int, b: int) -> int:
        return int(common_prefix(words, np.array([a]), np.array([b]), cap)[0]) if cap else 0

    symbols = np.unique(t).tolist()
    size = (1 << bits) if cap else 0
    first = t[star]
    queue = SuffixQueue(memory)
    larger: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    scan = Scan(t, ~s_type, size, cap, queue)
    bound = np.searchsorted(first, np.array(symbols + [symbols[-1] + 1]))
    for k, c in enumerate(symbols):
        last = -1
        while (got := queue.pop(c)) is not None:
            position, lcp = got
            if last < 0:
                lcp = lcp.copy()
                lcp[0] = 0
            larger.setdefault(c, []).append((position, lcp))
            last = int(position[-1])
            scan.feed(position, lcp)
        a, b = bound[k], bound[k + 1]
        if a < b:
            lcp = star_lcp[a:b].copy()
            lcp[0] = joint(last, int(star[a])) if last >= 0 else 0
            scan.feed(star[a:b], lcp)
    queue.close()
    queue = SuffixQueue(memory)
    scan = Scan(t, s_type, size, cap, queue)
    pieces = []
    for c in reversed(symbols):
        last, own = -1, []
        while (got := queue.pop(c)) is not None:
            position, lcp = got
            if last < 0:
                lcp = lcp.copy()
                lcp[0] = 0
            own.append((position, lcp))
            last = int(position[-1])
            scan.feed(position, lcp)
        if c == 0:
            own = [(np.array([n - 1], np.int32), np.zeros(1, np.uint8))]
        # Of type S, the smallest came last: its common prefix is with what stands below it.
        below = larger.pop(c, [])
        bridge = 0
        if below:
            position, lcp = (np.concatenate(x) for x in zip(*below))
            if last >= 0:
                bridge = joint(int(position[-1]), last)
            down = np.empty_like(lcp)
            down[0] = bridge
            down[1:] = lcp[:0:-1]
            scan.feed(position[::-1], down)
        if own:
            p, v = (np.concatenate(x) for x in zip(*own))
            up = np.empty_like(v)
            up[0] = bridge
            up[1:] = v[:0:-1]
            pieces.append((p[::-1], up))
        if below:
            pieces.append((position, lcp))
    queue.close()
    sa, lcp = (np.concatenate(x[::-1]) for x in zip(*pieces))
    return sa, lcp
