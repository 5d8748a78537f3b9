"""An R-tree over count vectors, for joins by a minimum overlap of token sets.

A set's tokens are hashed into groups; its point holds the number of tokens in each group. The overlap of two sets
is at most the sum of their points' coordinate-wise minima, and for a whole subtree at most that with the maxima
of its points. A Jaccard similarity of at least num / den asks for an overlap of at least
num / (num + den) of both sizes together, and for sizes of a ratio of at least num / den.
"""

from __future__ import annotations

import numpy as np

GROUPS = 256
LEAF = 16
FANOUT = 8
#: (query, node) pairs whose bounds are computed at once.
CHUNK = 8192


def count_vector(tokens: np.ndarray, groups: int = GROUPS) -> bytes:
    """Tokens of a set in each group, one byte each; 255 stands for any number from there."""
    spread = (tokens * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    counts = np.bincount((spread % np.uint64(groups)).astype(np.int64), minlength=groups)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def points_of(vectors: list[bytes]) -> np.ndarray:
    """Points of stored vectors; what a byte cannot tell becomes a number that no bound falls short of."""
    points = np.frombuffer(b"".join(vectors), dtype=np.uint8).reshape(len(vectors), -1).astype(np.uint16)
    points[points == 255] = 65535
    return points


def least_overlap(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Overlap that sets of these sizes need for a similarity of num / den."""
    return -(-num * (a + b) // (num + den))


class CountTree:
    """Bulk-loaded: points ordered by size and then by their fullest-spread group, packed into leaves."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.points, self.sizes = points, sizes
        n = len(points)
        order = np.argsort(sizes, kind="stable")
        slab = max(LEAF, int(np.sqrt(n * LEAF)))
        parts = []
        for low in range(0, n, slab):
            part = order[low:low + slab]
            widest = int(points[part].astype(np.int32).var(axis=0).argmax())
            parts.append(part[np.argsort(points[part, widest], kind="stable")])
        self.order = np.concatenate(parts) if parts else order
        #: levels from the leaves up: (maxima, least size, largest size, first child, end of children)
        self.levels = []
        maxima, small, large, width = points[self.order], sizes[self.order], sizes[self.order], LEAF
        while True:
            starts = np.arange(0, len(maxima), width)
            ends = np.minimum(starts + width, len(maxima))
            maxima = np.maximum.reduceat(maxima, starts, axis=0)
            small, large = np.minimum.reduceat(small, starts), np.maximum.reduceat(large, starts)
            self.levels.append((maxima, small, large, starts, ends))
            if len(starts) == 1:
                return
            width = FANOUT

    def matches(
        self, points: np.ndarray, sizes: np.ndarray, num: int, den: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, bound) of the pairs whose bound reaches the least overlap."""
        query = np.arange(len(points))
        node = np.zeros(len(points), dtype=np.int64)
        for maxima, small, large, starts, ends in reversed(self.levels):
            alive, _ = self._alive(points, sizes, query, node, maxima, small, large, num, den)
            query, node = query[alive], node[alive]
            counts = (ends - starts)[node]
            query = np.repeat(query, counts)
            first = np.repeat(starts[node], counts)
            node = first + np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
        rows = self.order[node]
        alive, bounds = self._alive(points, sizes, query, rows, self.points, self.sizes, self.sizes, num, den)
        return query[alive], rows[alive], bounds[alive]

    @staticmethod
    def _alive(points, sizes, query, node, maxima, small, large, num, den) -> tuple[np.ndarray, np.ndarray]:
        """Whether each (query, node) may hold a match, by sizes and then by the bound; and the bounds."""
        q = sizes[query]
        alive = (large[node] * den >= q * num) & (small[node] * num <= q * den)
        at = np.flatnonzero(alive)
        bounds = np.zeros(len(query), dtype=np.int64)
        for low in range(0, len(at), CHUNK):
            part = at[low:low + CHUNK]
            bound = np.minimum(points[query[part]], maxima[node[part]]).sum(axis=1, dtype=np.int64)
            # a subtree's least size that passes the size test asks for the least
            least = np.maximum(small[node[part]], -(-sizes[query[part]] * num // den))
            bounds[part] = bound
            alive[part] = bound >= least_overlap(sizes[query[part]], least, num, den)
        return alive, bounds
