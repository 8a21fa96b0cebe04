"""Local search on bins of pieces: exchanges that make full bins fuller until some are empty (used inside tasks).

An exchange takes a piece from a bin to one at least as full and gives back nothing (a move), one smaller piece or two smaller
pieces whose sizes add up to less, so the sum of squared fills goes up and the search ends. Any underfull bin gives and takes,
any pieces are exchanged. An exchange asks by size, not piece by piece: the reach of a piece (or of two of a bin) is its size and the gap
of its bin, so a piece of size x may take its place if x is at most the reach, and leaves reach - x of the gap. For
each reach there is a set of bits of the sizes that have it; the least reach from x on with a size below x makes the
fullest bin.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np


def least_bins(sizes: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing goes below: by tokens, and by what can't stand beside pieces above half.

    For each k up to half the capacity: pieces above capacity - k are alone, other ones above half need a bin each, and what pieces
    of k to half have too much for the rest of those bins needs more.
    """
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    number = np.concatenate(([0], np.cumsum(count)))  # number[n]: pieces smaller than n
    total = np.concatenate(([0], np.cumsum(count * np.arange(capacity + 1))))
    half = capacity // 2
    k = np.arange(half + 1)
    alone = number[-1] - number[capacity - k + 1]
    large = number[capacity - k + 1] - number[half + 1]
    room = large * capacity - (total[capacity - k + 1] - total[half + 1])
    small = total[half + 1] - total[k]
    return int((alone + large + np.maximum(0, -(-(small - room) // capacity))).max())


class Bins:
    """Bins with their pieces by size; underfull ones are indexed by gap."""

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.capacity = capacity
        self.items: list[dict[int, list[int]]] = []  # per bin, pieces by size
        self.fill: list[int] = []
        for pieces in bins:
            by_size: dict[int, list[int]] = defaultdict(list)
            for i in pieces:
                by_size[sizes[i]].append(i)
            self.items.append(by_size)
            self.fill.append(sum(sizes[i] for i in pieces))
        self.gaps: dict[int, set[int]] = defaultdict(set)  # bins by gap
        # For pieces and for two of a bin: by reach and size (sum), the bins that have them; and by reach, bits of these sizes.
        self.index: tuple[dict[int, dict[int, set[int]]], ...] = (defaultdict(dict), defaultdict(dict))
        self.bits = ([0] * (2 * capacity + 1), [0] * (2 * capacity + 1))
        for b in range(len(bins)):
            self._add(b)

    def _sums(self, b: int) -> set[int]:
        sizes = list(self.items[b])
        sums = {s + t for k, s in enumerate(sizes) for t in sizes[:k]}
        sums.update(2 * s for s in sizes if len(self.items[b][s]) > 1)
        return sums

    def _add(self, b: int) -> None:
        gap = self.capacity - self.fill[b]
        if not 0 < gap < self.capacity:
            return
        self.gaps[gap].add(b)
        for table, bits, found in zip(self.index, self.bits, (self.items[b], self._sums(b)), strict=True):
            for s in found:
                bins = table[s + gap].setdefault(s, set())
                if not bins:
                    bits[s + gap] |= 1 << s
                bins.add(b)

    def _drop(self, b: int) -> None:
        gap = self.capacity - self.fill[b]
        if not 0 < gap < self.capacity:
            return
        self.gaps[gap].discard(b)
        for table, bits, found in zip(self.index, self.bits, (self.items[b], self._sums(b)), strict=True):
            for s in found:
                bins = table[s + gap][s]
                bins.discard(b)
                if not bins:
                    bits[s + gap] ^= 1 << s
        if not self.gaps[gap]:
            del self.gaps[gap]

    def _exchange(self, a: int, x: int, b: int, back: tuple[int, ...]) -> None:
        """A piece of size ``x`` goes from bin ``a`` to ``b``, pieces of sizes ``back`` the other way."""
        self._drop(a)
        self._drop(b)
        for source, target, sizes in ((a, b, (x,)), (b, a, back)):
            for s in sizes:
                piece = self.items[source][s].pop()
                if not self.items[source][s]:
                    del self.items[source][s]
                self.items[target][s].append(piece)
                self.fill[source] -= s
                self.fill[target] += s
        self._add(a)
        self._add(b)

    def _other(self, bins: set[int], a: int) -> int | None:
        return next((b for b in bins if b != a), None)

    def _swap(self, a: int, x: int, k: int) -> tuple[int, int] | None:
        """(bin, size or sum to give back) that fills a bin best with a piece of size ``x`` from ``a``."""
        own = self.capacity - self.fill[a]
        table, bits = self.index[k], self.bits[k]
        below = (1 << x) - 1
        for reach in range(x, x + own):  # a size below x, in a bin with a gap up to that of a
            found = bits[reach] & below
            if found:
                low = max(1, reach - own)
                found = found >> low << low
                while found:
                    s = (found & -found).bit_length() - 1
                    b = self._other(table[reach][s], a)
                    if b is not None:
                        return b, s
                    found &= found - 1
        return None

    def _pair(self, b: int, total: int) -> tuple[int, int]:
        held = self.items[b]
        return next((s, total - s) for s in held if total - s in held and (2 * s != total or len(held[s]) > 1))

    def give(self, a: int) -> bool:
        """One exchange that takes tokens from bin ``a`` to one at least as full."""
        own = self.capacity - self.fill[a]
        for x in sorted(self.items[a], reverse=True):
            if x <= own:  # a move, to the fullest bin that takes it
                for gap in sorted(g for g in self.gaps if x <= g <= own):
                    b = self._other(self.gaps[gap], a)
                    if b is not None:
                        self._exchange(a, x, b, ())
                        return True
            for k in (0, 1):
                found = self._swap(a, x, k)
                if found:
                    b, s = found
                    self._exchange(a, x, b, self._pair(b, s) if k else (s,))
                    return True
        return False

    def used(self) -> int:
        return sum(f > 0 for f in self.fill)

    def members(self) -> list[list[int]]:
        return [sorted(i for pieces in by_size.values() for i in pieces) for by_size in self.items if by_size]


def improve(sizes: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Exchange while there are more bins than any packing needs and an exchange is found: to the local optimum."""
    least = least_bins(np.array(sizes, np.int64), capacity)
    state = Bins(sizes, bins, capacity)
    left = state.used()
    going = left > least
    while going:
        going = False
        # The emptiest give first; what a round changes is looked at again in the next one.
        for a in sorted((b for b, f in enumerate(state.fill) if 0 < f < capacity), key=lambda b: (state.fill[b], b)):
            while 0 < state.fill[a] < capacity and state.give(a):
                going = True
            left -= state.fill[a] == 0
            if left <= least:
                return state.members()
    return state.members()
