"""An R-tree over count vectors, for pairs of sets with a large overlap.

The tokens of a set are hashed into groups; how many fall into each group is a point. The
sum of the smaller coordinates of two points bounds the overlap of their sets from above, and
the sum of the smaller upper corners of two boxes bounds it for all points inside them. Two
sets are close when 9 * overlap >= 4 * (size + size), that is at a Jaccard similarity of 0.8.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

#: Groups of a point. Boxes are kept over so many sums of them, which bound the overlap less tightly but cost less.
GROUPS, BOX_GROUPS = 1024, 128
LEAF = 24
#: Pairs of points that are compared at a time.
PAIRS_AT_ONCE = 1024


def count_vector(tokens: np.ndarray) -> np.ndarray:
    return np.bincount((tokens % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)


def packed_counts(tokens: np.ndarray) -> bytes:
    """A count vector in few bytes."""
    counts = count_vector(tokens)
    return zlib.compress(counts.astype("u1" if counts.max(initial=0) < 256 else "<u4").tobytes(), 6)


def unpacked_counts(packed: bytes) -> np.ndarray:
    raw = zlib.decompress(packed)
    return np.frombuffer(raw, "u1" if len(raw) == GROUPS else "<u4")


class CountTree:
    """Points packed into leaves, leaves into boxes of boxes up to one root."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.points, self.sizes = points, sizes.astype(np.int64)
        self.sums = points.reshape(len(points), -1, BOX_GROUPS).sum(axis=1, dtype=np.int64)
        # by size, then along one direction: near sets get into the same leaf
        direction = np.random.default_rng(3).standard_normal(BOX_GROUPS)
        slab = np.floor(np.log(np.maximum(self.sizes, 1)) / 0.1)
        self.order = np.lexsort((np.arange(len(sizes)), np.round(self.sums @ direction, 6), slab))
        self.leaves = [self.order[k:k + LEAF] for k in range(0, len(self.order), LEAF)]
        self.high = [np.stack([self.sums[leaf].max(axis=0) for leaf in self.leaves])]
        self.least = [np.array([self.sizes[leaf].min() for leaf in self.leaves])]
        self.most = [np.array([self.sizes[leaf].max() for leaf in self.leaves])]
        while len(self.high[-1]) > 1:
            cuts = range(0, len(self.high[-1]), LEAF)
            self.high.append(np.stack([self.high[-1][k:k + LEAF].max(axis=0) for k in cuts]))
            self.least.append(np.array([self.least[-1][k:k + LEAF].min() for k in cuts]))
            self.most.append(np.array([self.most[-1][k:k + LEAF].max() for k in cuts]))

    def close_leaves(self, leaf: int) -> list[int]:
        """The leaves from this one on that may hold a set close to one of its own, found from the root down."""
        high, least, most = self.high[0][leaf], self.least[0][leaf], self.most[0][leaf]
        nodes = np.array([0])
        for level in range(len(self.high) - 1, -1, -1):
            bound = np.minimum(self.high[level][nodes], high).sum(axis=1)
            near = (
                (9 * bound >= 4 * (self.least[level][nodes] + least))
                & (10 * self.most[level][nodes] >= 8 * least) & (10 * most >= 8 * self.least[level][nodes])
            )
            nodes = nodes[near]
            if level:
                nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = nodes[nodes < len(self.high[level - 1])]
        return [int(n) for n in nodes if n >= leaf]

    def close(self, left: np.ndarray, right: np.ndarray, wanted: np.ndarray) -> list[tuple[int, int]]:
        """Places of the ``wanted`` pairs of points ``left`` and ``right`` that may be close."""
        needed = 4 * (self.sizes[left][:, None] + self.sizes[right][None, :])
        bound = np.minimum(self.sums[left][:, None, :], self.sums[right][None, :, :]).sum(axis=2)
        rows, columns = np.nonzero(wanted & (9 * bound >= needed))
        found = []
        for start in range(0, len(rows), PAIRS_AT_ONCE):
            i, j = rows[start:start + PAIRS_AT_ONCE], columns[start:start + PAIRS_AT_ONCE]
            tight = np.minimum(self.points[left[i]], self.points[right[j]]).sum(axis=1, dtype=np.int64)
            near = 9 * tight >= needed[i, j]
            found += zip(i[near].tolist(), j[near].tolist())
        return found

    def forest(self) -> Iterator[tuple[int, int]]:
        """Pairs that may be close, as few as connect what such pairs connect."""
        root = list(range(len(self.sizes)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for number, leaf in enumerate(self.leaves):
            for other in self.close_leaves(number):
                members = self.leaves[other]
                tops = {find(int(x)) for x in leaf} | {find(int(x)) for x in members}
                if len(tops) < 2:
                    continue
                every = np.ones((len(leaf), len(members)), bool)
                for i, j in self.close(leaf, members, np.triu(every, 1) if number == other else every):
                    a, b = int(leaf[i]), int(members[j])
                    if (x := find(a)) != (y := find(b)):
                        root[max(x, y)] = min(x, y)
                        yield a, b

    def pairs(self, component: np.ndarray, side: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
        """All pairs of different components that may be close; with sides, only those across them."""
        for number, leaf in enumerate(self.leaves):
            own = component[leaf]
            for other in self.close_leaves(number):
                members = self.leaves[other]
                theirs = component[members]
                apart = own[:, None] != theirs[None, :]
                if side is not None:
                    apart &= side[leaf][:, None] != side[members][None, :]
                if number == other:
                    apart = np.triu(apart, 1)
                if apart.any():
                    for i, j in self.close(leaf, members, apart):
                        yield int(leaf[i]), int(members[j])
