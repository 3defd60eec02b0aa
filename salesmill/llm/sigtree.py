"""Signature trees: which sets of a block may resemble each other, by a dual traversal.

A leaf stands for one set: its size and a bitmap of its members. A node holds the OR of its
children's bitmaps and the range of their sizes. Two nodes can only lead to a pair of enough overlap
if their size ranges allow it and if their common bits, plus the members that share a bit inside one
set, reach the overlap that the smallest sizes require. Pairs of nodes that fail are dropped
unopened. No pair of sets that resemble each other is ever dropped.

A bitmap has four to eight bits for each member, a power of two. A larger bitmap is folded before it
meets a smaller one; sets whose sizes allow a pair differ by one power at most.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FANOUT = 8
CHUNK = 4096
MOST_BITS = 1 << 17


@dataclass
class Level:
    bits: np.ndarray  # rows of 64-bit words
    least: np.ndarray  # smallest and largest set below
    most: np.ndarray
    spare: np.ndarray  # most members of one set that share a bit with another of its members
    low: np.ndarray  # smallest and largest component below
    high: np.ndarray


class Components:
    """Union-find over the sets of one block; `find` gives the smallest number of a component."""

    def __init__(self, start: np.ndarray):
        self.parent = start.copy()

    def find(self, i: int) -> int:
        root = i
        while self.parent[root] != root:
            root = self.parent[root]
        while self.parent[i] != root:
            self.parent[i], i = root, self.parent[i]
        return root

    def union(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        found = self.parent
        while not np.array_equal(found, found[found]):
            found = found[found]
        return found


def bitmap(members: np.ndarray) -> bytes:
    """The bitmap of a set of 64-bit hashes."""
    bits = min(MOST_BITS, max(64, 1 << (4 * len(members) - 1).bit_length()))
    flags = np.zeros(bits, bool)
    flags[(members & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _rows(bitmaps: list[bytes], bits: int) -> np.ndarray:
    """Bitmaps as rows of `bits` bits; those of twice the size are folded."""
    rows = []
    for b in bitmaps:
        row = np.frombuffer(b, np.uint64)
        rows.append(row if 8 * len(b) == bits else row[: len(row) // 2] | row[len(row) // 2 :])
    return np.stack(rows)


def _tree(bits: np.ndarray, sizes: np.ndarray, roots: np.ndarray) -> list[Level]:
    """Levels from the leaves up; node i of a level holds nodes FANOUT*i .. of the level below."""
    spare = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    levels = [Level(bits, sizes, sizes, spare, roots, roots)]
    while len(levels[-1].least) > 1:
        below = levels[-1]
        first = np.arange(0, len(below.least), FANOUT)
        levels.append(Level(
            np.bitwise_or.reduceat(below.bits, first),
            np.minimum.reduceat(below.least, first), np.maximum.reduceat(below.most, first),
            np.maximum.reduceat(below.spare, first),
            np.minimum.reduceat(below.low, first), np.maximum.reduceat(below.high, first),
        ))
    return levels


def _possible(level: Level, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of nodes that may hold a pair of sets with enough overlap, not yet in one component."""
    apart = ~((level.low[a] == level.high[a]) & (level.low[b] == level.high[b]) & (level.low[a] == level.low[b]))
    sized = (100 * level.most[b] >= percent * level.least[a]) & (100 * level.most[a] >= percent * level.least[b])
    keep = np.flatnonzero(apart & sized)
    a, b = a[keep], b[keep]
    overlap = np.bitwise_count(level.bits[a] & level.bits[b]).sum(axis=1, dtype=np.int64)
    overlap += np.minimum(level.spare[a], level.spare[b])
    # 100 * overlap >= percent * union is (100 + percent) * overlap >= percent * (size + size)
    return keep[(100 + percent) * overlap >= percent * (level.least[a] + level.least[b])]


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted arrays of distinct values."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    common = int(np.count_nonzero(y[at] == x))
    return 100 * common >= percent * (len(x) + len(y) - common)


def few_candidates(
    bitmaps: list[bytes], sizes: list[int], percent: int, groups: list[int], spanning: bool = False
) -> list[tuple[int, int]]:
    """`candidates` for sets that fit one node, whose children are its leaves: plain integers do."""
    found, group = [], list(groups)
    bits = [int.from_bytes(b, "little") for b in bitmaps]
    spare = [n - b.bit_count() for n, b in zip(sizes, bits)]
    for j in range(1, len(sizes)):
        for i in range(j):
            if group[i] == group[j] or 100 * min(sizes[i], sizes[j]) < percent * max(sizes[i], sizes[j]):
                continue
            x, y, a, b = bits[i], bits[j], spare[i], spare[j]
            if len(bitmaps[i]) != len(bitmaps[j]):
                half = 8 * min(len(bitmaps[i]), len(bitmaps[j]))
                x, y = (w >> half | w & ((1 << half) - 1) for w in (x, y))
                a, b = sizes[i] - x.bit_count(), sizes[j] - y.bit_count()
            if (100 + percent) * ((x & y).bit_count() + min(a, b)) >= percent * (sizes[i] + sizes[j]):
                found.append((i, j))
                if spanning:
                    group = [group[i] if g == group[j] else g for g in group]
    return found


def candidates(
    bitmaps: list[bytes], sizes: np.ndarray, order_key: np.ndarray, percent: int,
    groups: np.ndarray | None = None, spanning: bool = False,
) -> list[tuple[int, int]]:
    """Pairs of sets whose Jaccard may reach percent / 100, in no particular order.

    `groups` numbers sets known to be connected; pairs inside one are left out. `order_key` puts sets
    that are alike side by side in the tree. With `spanning`, a pair that is found counts as
    connected at once, so n sets give fewer than n pairs; without, every possible pair is returned.
    """
    width = np.array([8 * len(b) for b in bitmaps], np.int64)
    start = np.arange(len(bitmaps))
    if groups is not None:
        _, first, inverse = np.unique(groups, return_index=True, return_inverse=True)
        start = first[inverse]
    parts, found = Components(start), []
    for bits in np.unique(width):
        mine = np.flatnonzero((width == bits) | (width == 2 * bits))
        mine = mine[np.lexsort((order_key[mine], np.log2(sizes[mine]).astype(np.int64)))]
        own = width[mine] == bits
        if len(mine) < 2:
            continue
        levels = _tree(_rows([bitmaps[i] for i in mine], int(bits)), sizes[mine], parts.roots()[mine])

        def meet(a, b):
            for i, j in zip(mine[a].tolist(), mine[b].tolist()):
                if not spanning:
                    found.append((i, j))
                elif parts.find(i) != parts.find(j):
                    parts.union(i, j)
                    found.append((i, j))

        if spanning:  # neighbours first: what they join need not be opened again
            a = np.arange(len(mine) - 1)
            a = a[own[a] | own[a + 1]]
            near = _possible(levels[0], a, a + 1, percent)
            meet(a[near], a[near] + 1)
            levels = _tree(levels[0].bits, sizes[mine], parts.roots()[mine])
        stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        step = np.arange(FANOUT)
        while stack:
            depth, a, b = stack.pop()
            level = levels[depth]
            if depth == 0:
                roots = parts.roots()[mine]
                level = Level(level.bits, level.least, level.most, level.spare, roots, roots)
            keep = _possible(level, a, b, percent)
            a, b = a[keep], b[keep]
            if depth == 0:
                meet(a, b)
                continue
            # Open the children of both nodes; each unordered pair once.
            x = np.repeat(a[:, None] * FANOUT + step, FANOUT, axis=1).ravel()
            y = np.tile(b[:, None] * FANOUT + step, FANOUT).ravel()
            there = len(levels[depth - 1].least)
            fits = (x < there) & (y < there) & ((x < y) if depth == 1 else (x <= y))
            x, y = x[fits], y[fits]
            if depth == 1:  # a pair of two wider bitmaps is met at their own width
                narrow = own[x] | own[y]
                x, y = x[narrow], y[narrow]
            stack += [(depth - 1, x[i : i + CHUNK], y[i : i + CHUNK]) for i in range(0, len(x), CHUNK)]
    return found
