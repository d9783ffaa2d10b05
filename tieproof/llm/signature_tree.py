"""Sets that overlap enough, found by the dual traversal of a signature tree.

A node of the tree holds the union of its sets' bitmaps, the range of their
sizes, and the most elements of one set that fell on a bit already taken. Two
sets can share no more elements than their bitmaps share bits, plus the elements
that fell on taken bits; for nodes the same holds of the unions. A pair of nodes
is left out if its sizes are too far apart, if that bound is below what the
smallest sizes ask for, or if all below them is linked already.
"""

from __future__ import annotations

import numpy as np

LEAF, FAN = 32, 4


def bitmap(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` bits (a power of two, 64 or more) as 64-bit words."""
    out = np.zeros(bits, np.uint8)
    out[(values >> np.uint64(20)) & np.uint64(bits - 1)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def bits_for(size: int) -> int:
    """One to two bits for each element."""
    return max(64, 1 << (max(1, size) - 1).bit_length())


def folded(words: np.ndarray, bits: int) -> np.ndarray:
    """The bitmap of the same values with fewer bits."""
    while len(words) * 64 > bits:
        half = len(words) // 2
        words = words[:half] | words[half:]
    return words


class Links:
    """Which items are linked already; those of one group are from the start."""

    def __init__(self, groups):
        first: dict = {}
        self.up = [first.setdefault(g, i) for i, g in enumerate(groups)]

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


class Tree:
    """``sizes`` of sets, their ``maps`` (rows of 64-bit words, of one length), ``percent`` of the union to be shared."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray, percent: int = 80):
        self.percent = percent
        self.order = np.argsort(sizes, kind="stable")
        self.size, self.maps = sizes[self.order].astype(np.int64), maps[self.order]
        self.taken = self.size - np.bitwise_count(self.maps).sum(1).astype(np.int64)
        # levels from the leaves up: bounds of each node's items
        n = len(sizes)
        self.levels = []
        step = LEAF
        while True:
            lo = np.arange(0, n, step)
            self.levels.append((lo, np.minimum(lo + step, n), np.bitwise_or.reduceat(self.maps, lo, axis=0),
                                np.maximum.reduceat(self.taken, lo)))
            if len(lo) <= 1:
                break
            step *= FAN

    def _need(self, small: int, large: int) -> int:
        """Elements that two sets of these sizes must share: their share of the union."""
        return -(-self.percent * (small + large) // (100 + self.percent))

    def _apart(self, lo: int, hi: int) -> bool:
        """A set of at most ``lo`` elements can't reach the share with one of at least ``hi``."""
        return 100 * lo < self.percent * hi

    def walk(self, linked: Links, test, side: np.ndarray | None = None) -> None:
        """Links what belongs together. ``test(i, j)`` decides on a pair that the bounds leave; without it (None)
        every such pair counts. With ``side``, only pairs of items of different sides are looked at."""
        side = None if side is None else side[self.order]
        top = len(self.levels) - 1
        stack = [(top, 0, top, 0)]
        while stack:
            la, a, lb, b = stack.pop()
            lo_a, hi_a = int(self.levels[la][0][a]), int(self.levels[la][1][a])
            lo_b, hi_b = int(self.levels[lb][0][b]), int(self.levels[lb][1][b])
            # sizes are in order: the largest of the first node against the smallest of the second
            if self._apart(int(self.size[hi_a - 1]), int(self.size[lo_b])):
                continue
            if (la, a) != (lb, b):
                shared = int(np.bitwise_count(self.levels[la][2][a] & self.levels[lb][2][b]).sum())
                most = shared + min(int(self.levels[la][3][a]), int(self.levels[lb][3][b]))
                if most < self._need(int(self.size[lo_a]), int(self.size[lo_b])):
                    continue
            roots = {linked.find(int(self.order[i])) for i in (*range(lo_a, hi_a), *range(lo_b, hi_b))} if la else None
            if roots is not None and len(roots) == 1:
                continue
            if la == 0:
                self._leaves(lo_a, hi_a, lo_b, hi_b, linked, test, side)
                continue
            kids = lambda lo, hi: range(lo // (LEAF * FAN ** (la - 1)), -(-hi // (LEAF * FAN ** (la - 1))))
            pairs = [(la - 1, i, lb - 1, j) for i in kids(lo_a, hi_a) for j in kids(lo_b, hi_b) if i <= j]
            stack += reversed(pairs)

    def _leaves(self, lo_a, hi_a, lo_b, hi_b, linked, test, side) -> None:
        sizes = self.size[lo_a:hi_a, None] + self.size[None, lo_b:hi_b]
        shared = np.bitwise_count(self.maps[lo_a:hi_a, None] & self.maps[None, lo_b:hi_b]).sum(2, dtype=np.int64)
        most = np.minimum(shared + np.minimum(self.taken[lo_a:hi_a, None], self.taken[None, lo_b:hi_b]),
                          np.minimum(self.size[lo_a:hi_a, None], self.size[None, lo_b:hi_b]))
        # share of the union: percent * (sum - shared) <= 100 * shared
        left = 100 * most >= self.percent * (sizes - most)
        roots = np.array([linked.find(int(i)) for i in (*self.order[lo_a:hi_a], *self.order[lo_b:hi_b])])
        left &= roots[:hi_a - lo_a, None] != roots[None, hi_a - lo_a:]
        if side is not None:
            left &= side[lo_a:hi_a, None] != side[None, lo_b:hi_b]
        for i, j in np.argwhere(left):
            i, j = int(lo_a + i), int(lo_b + j)
            x, y = int(self.order[i]), int(self.order[j])
            if i < j and linked.find(x) != linked.find(y) and (test is None or test(x, y)):
                linked.join(x, y)


def shared_elements(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
