"""Longest common extensions in sequences of numbers, by a difference cover (numpy, used inside tasks).

A cover of residues modulo ``CYCLE`` has for every difference two members that far apart, so from any two places a
few steps lead to two places that are both sampled: at most ``CYCLE - 1``. Only suffixes at sampled places are sorted: first by
their next ``CYCLE`` numbers, then by doubling, since the place ``CYCLE`` further on is sampled as well. An extension compares
the few numbers up to the sampled places, and from there takes the minimum of the common prefixes between the two
ranks, from a sparse table.
"""

from __future__ import annotations

import numpy as np

# A perfect difference set (fixed values): every residue but 0 is the difference of exactly one pair.
CYCLE = 31
COVER = (1, 5, 11, 24, 25, 27)


def _steps() -> np.ndarray:
    """Per difference d, a residue r so that r and r + d are both in the cover."""
    out = np.zeros(CYCLE, np.int64)
    for a in COVER:
        for b in COVER:
            out[(b - a) % CYCLE] = a
    return out


_STEP = _steps()
_RANK_IN_COVER = np.full(CYCLE, -1, np.int64)
_RANK_IN_COVER[list(COVER)] = np.arange(len(COVER))


class Extensions:
    """Answers for many pairs of places (i, j) at once how far the sequence goes on alike from both.

    ``groups`` says which part a place lies in, ascending; pairs are asked within a part only, and each part must end with a
    number that occurs nowhere else.
    """

    def __init__(self, numbers: np.ndarray, groups: np.ndarray):
        self.size = len(numbers)
        self.numbers = np.concatenate((numbers, np.full(2 * CYCLE, -1, np.int64)))
        cycles = -(-self.size // CYCLE)
        place = (np.arange(cycles)[:, None] * CYCLE + np.array(COVER)).ravel()
        self.sampled = place[place < self.size]  # ascending, as the cover is
        self._sort(groups[self.sampled])
        self._tabulate()

    def _index(self, place: np.ndarray) -> np.ndarray:
        """Number of a sampled place among the sampled ones."""
        return place // CYCLE * len(COVER) + _RANK_IN_COVER[place % CYCLE]

    def _sort(self, groups: np.ndarray) -> None:
        """Ranks of the sampled suffixes, parts apart."""
        m = len(self.sampled)
        bits = max(1, int(self.numbers.max(initial=0) + 2).bit_length())
        per_key = max(1, 63 // bits)
        keys = [groups]
        for begin in range(0, CYCLE, per_key):
            key = np.zeros(m, np.int64)
            for c in range(begin, min(begin + per_key, CYCLE)):
                key = (key << bits) | (self.numbers[self.sampled + c] + 1)
            keys.append(key)
        order = np.lexsort(keys[::-1])
        fresh = np.zeros(m, bool)
        for key in keys:
            fresh[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(m, np.int64)
        rank[order] = np.cumsum(fresh)
        self.levels = [rank]  # equal ranks at level k: alike for CYCLE * 2**k numbers at least, or to the end of the part
        jump = len(COVER)
        while m and rank.max() < m - 1:
            ahead = np.full(m, -1, np.int64)
            ahead[: max(0, m - jump)] = rank[jump:]
            order = np.lexsort((ahead, rank))
            fresh = np.zeros(m, bool)
            fresh[1:] = (rank[order][1:] != rank[order][:-1]) | (ahead[order][1:] != ahead[order][:-1])
            rank = np.empty(m, np.int64)
            rank[order] = np.cumsum(fresh)
            self.levels.append(rank)
            jump *= 2
        self.rank = rank
        self.order = np.empty(m, np.int64)
        self.order[rank] = np.arange(m)

    def _tabulate(self) -> None:
        """Common prefixes of neighbours in rank, and their minima over runs of 1, 2, 4, ... neighbours."""
        one, other = self.order[:-1].copy(), self.order[1:].copy()
        common = np.zeros(len(one), np.int64)
        m = len(self.sampled)
        for level in range(len(self.levels) - 1, -1, -1):
            jump = len(COVER) << level
            inside = (one < m) & (other < m)
            alike = inside.copy()
            alike[inside] = self.levels[level][one[inside]] == self.levels[level][other[inside]]
            common[alike] += CYCLE << level
            one[alike] += jump
            other[alike] += jump
        at = self.sampled[self.order[:-1]] + common
        to = self.sampled[self.order[1:]] + common
        common += self._compare(at, to, np.full(len(at), CYCLE, np.int64))
        self.minima = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _compare(self, one: np.ndarray, other: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many of the next ``most`` (at most ``CYCLE``) numbers are alike."""
        out = np.zeros(len(one), np.int64)
        going = np.flatnonzero(most > 0)
        for step in range(CYCLE):
            a, b = one[going] + step, other[going] + step
            inside = (a < self.size) & (b < self.size)
            alike = inside & (self.numbers[np.minimum(a, self.size)] == self.numbers[np.minimum(b, self.size)])
            going = going[alike]
            out[going] += 1
            going = going[most[going] > step + 1]
            if not len(going):
                break
        return out

    def common(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of each pair of places (which differ and lie in one part)."""
        steps = (_STEP[(other - one) % CYCLE] - one) % CYCLE
        out = self._compare(one, other, steps)
        far = np.flatnonzero(out == steps)  # alike up to two sampled places, if these are still there
        a, b = one[far] + steps[far], other[far] + steps[far]
        inside = (a < self.size) & (b < self.size)
        far, a, b = far[inside], a[inside], b[inside]
        low, high = self.rank[self._index(a)], self.rank[self._index(b)]
        low, high = np.minimum(low, high), np.maximum(low, high)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            some = level == k
            table = self.minima[k]
            out[far[some]] += np.minimum(table[low[some]], table[high[some] - (1 << int(k))])
        return out
