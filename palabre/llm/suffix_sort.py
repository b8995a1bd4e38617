"""Anchors of byte strings, and a suffix sort that compares suffixes by prefix hashes.

Everything here works on whole numpy arrays inside a task and knows nothing of Spark.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20_260_211)
#: A random odd 64-bit value for each byte.
_VALUES = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD1342543DE82EF95
#: Positions that are hashed at once: their arrays stay in a core's cache.
CHUNK = 1 << 15


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


class PrefixHashes:
    """Polynomial hashes (modulo 2^64) of all prefixes of a byte array.

    The hash of any stretch is then a difference of two of them, so two stretches are
    compared in constant time.
    """

    _up = _powers(_BASE, 1 << 17)
    _down = _powers(pow(_BASE, -1, 1 << 64), 1 << 17)

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        if len(self._up) <= n:
            type(self)._up = _powers(_BASE, 2 * n)
            type(self)._down = _powers(pow(_BASE, -1, 1 << 64), 2 * n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data] * self._up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """A hash of the bytes from each start on, the same wherever they stand."""
        return (self.sums[start + length] - self.sums[start]) * self._down[start]

    def all_of(self, length: int) -> np.ndarray:
        """The hash of every stretch of this length."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self._down[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of hashes, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each run of ``width`` values, by runs of doubled width."""
    done, least = 1, values
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    rest = width - done
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """For every string of ``length`` bytes the place of its least-hashed gram, as runs.

    Neighbouring strings mostly have the same anchor. Returns for each run its first and
    last start, the anchor's place and the anchor's hash. Which gram a string is anchored
    at depends on its own bytes only (the leftmost of equal ones), so equal strings have
    equal anchors at equal distances.
    """
    width = length - gram + 1
    starts = len(data) - length + 1
    firsts, places, hashes = [], [], []
    before = -1
    for c in range(0, max(0, starts), CHUNK):
        part = data[c : min(c + CHUNK, starts) + length - 1]
        grams = _mix(PrefixHashes(part).all_of(gram))
        low = np.uint64((1 << 20) - 1)
        ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        place = (_sliding_minimum(ranked, width) & low).view(np.int64)
        new = np.flatnonzero(np.append(place[0] != before - c, place[1:] != place[:-1]))
        firsts.append(new + c)
        places.append(place[new] + c)
        hashes.append(grams[place[new]])
        before = int(place[-1]) + c
    if not firsts:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64)
    first = np.concatenate(firsts)
    last = np.append(first[1:], starts) - 1
    return first, last, np.concatenate(places), np.concatenate(hashes)


class SuffixSorter:
    """Sorts suffixes of a byte array, cut to ``length`` bytes, within given groups.

    Every suffix has so many bytes at least.
    A comparison finds the common extension of two suffixes by binary search over
    prefix hashes, so it takes log2(length) steps. The sort is a bottom-up mergesort:
    every element's rank in the neighbouring run is found by binary search, for all runs
    and groups at once.
    """

    def __init__(self, data: np.ndarray, length: int) -> None:
        self.data, self.length = data, length
        self.hashes = PrefixHashes(data)
        #: How many pairs of suffixes were compared.
        self.comparisons = 0

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes at ``a`` and ``b`` have in common, at most ``length``."""
        self.comparisons += len(a)
        low = np.zeros(len(a), dtype=np.int64)
        high = np.full(len(a), self.length, dtype=np.int64)
        same = self.hashes.of(a, self.length) == self.hashes.of(b, self.length)
        low[same] = self.length
        open_ = np.flatnonzero(~same)
        high[open_] -= 1
        while len(open_):
            middle = (low[open_] + high[open_] + 1) >> 1
            equal = self.hashes.of(a[open_], middle) == self.hashes.of(b[open_], middle)
            low[open_] = np.where(equal, middle, low[open_])
            high[open_] = np.where(equal, high[open_], middle - 1)
            open_ = open_[low[open_] < high[open_]]
        return low

    def _after(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which suffixes at ``a`` come after those at ``b``, and which are equal to them."""
        shared = self.common(a, b)
        equal = shared >= self.length
        at = np.where(equal, 0, shared)
        return ~equal & (self.data[a + at] > self.data[b + at]), equal

    def sort(self, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """The order that sorts ``starts`` by group, then by suffix."""
        order = np.argsort(groups, kind="stable")
        named = groups[order]
        edges = np.flatnonzero(np.diff(named, prepend=named[:1] - 1)) if len(named) else order
        sizes = np.diff(np.append(edges, len(named)))
        group_first = np.repeat(edges, sizes)
        group_end = group_first + np.repeat(sizes, sizes)
        spot = np.arange(len(order))
        width = 1
        while len(sizes) and width < sizes.max():
            block = group_first + (spot - group_first) // (2 * width) * (2 * width)
            middle = block + width
            moving = np.flatnonzero(middle < group_end)
            left = moving < middle[moving]
            low = np.where(left, middle[moving], block[moving])
            end = np.minimum(middle[moving] + width, group_end[moving])
            high = np.where(left, end, middle[moving])
            base = low.copy()
            own = starts[order[moving]]
            open_ = np.arange(len(moving))
            while len(open_):
                probe = (low[open_] + high[open_]) >> 1
                after, equal = self._after(own[open_], starts[order[probe]])
                # An equal one of the left run stays before that of the right run.
                further = after | (equal & ~left[open_])
                low[open_] = np.where(further, probe + 1, low[open_])
                high[open_] = np.where(further, high[open_], probe)
                open_ = open_[low[open_] < high[open_]]
            rank = low - base
            target = np.where(left, moving + rank, moving - width + rank)
            merged = order.copy()
            merged[target] = order[moving]
            order = merged
            width *= 2
        return order

    def repeated(self, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Which of the suffixes share all ``length`` bytes with another of their group.

        Neighbours that the hashes call equal are compared byte by byte. If one pair
        turns out unequal, the bytes themselves are sorted instead.
        """
        found = np.zeros(len(starts), dtype=bool)
        if len(starts) < 2:
            return found
        order = self.sort(starts, groups)
        a, b = order[:-1], order[1:]
        near = np.flatnonzero(groups[a] == groups[b])
        near = near[self.common(starts[a[near]], starts[b[near]]) >= self.length]
        if not self._same_bytes(starts[a[near]], starts[b[near]]):
            return self._repeated_bytes(starts, groups)
        found[a[near]] = found[b[near]] = True
        return found

    def _same_bytes(self, a: np.ndarray, b: np.ndarray) -> bool:
        windows = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        return all(
            np.array_equal(windows[a[i : i + 8192]], windows[b[i : i + 8192]])
            for i in range(0, len(a), 8192)
        )

    def _repeated_bytes(self, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        rows = [(g, self.data[s : s + self.length].tobytes()) for s, g in zip(starts, groups, strict=True)]
        counts: dict = {}
        for row in rows:
            counts[row] = counts.get(row, 0) + 1
        return np.array([counts[row] > 1 for row in rows], dtype=bool)
