"""A packed R-tree over count vectors, searched for points whose overlap bound reaches what they need."""

from __future__ import annotations

import numpy as np

FAN_OUT = 16
QUERIES_AT_ONCE = 64


def needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least common items of sets of a and b items with 100 * intersection >= 80 * union."""
    return (4 * (a + b) + 8) // 9


class CountTree:
    """Points are rows of `counts`; `sizes` are the set sizes, equal to the rows' sums.

    A node knows the maximum of each coordinate and the smallest size below it. No set below a node
    shares more items with a query than the sum of the coordinate minima of query and node maxima.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        # Packed by size, then by the fullest coordinate: near copies fall into the same leaf.
        self.order = np.lexsort((counts.argmax(1), sizes))
        self.counts, self.sizes = counts[self.order], sizes[self.order]
        self.levels = []
        top, least = self.counts, self.sizes
        while len(top) > FAN_OUT:
            cut = np.arange(0, len(top), FAN_OUT)
            top, least = np.maximum.reduceat(top, cut), np.minimum.reduceat(least, cut)
            self.levels.append((top, least))

    def search(self, counts: np.ndarray, sizes: np.ndarray):
        """Yield (query, point, bound) arrays, a block of queries at a time."""
        for low in range(0, len(counts), QUERIES_AT_ONCE):
            q, s = counts[low : low + QUERIES_AT_ONCE], sizes[low : low + QUERIES_AT_ONCE]
            top = self.levels[-1] if self.levels else (self.counts, self.sizes)
            who, node = (x.ravel() for x in np.indices((len(q), len(top[0]))))
            for depth in range(len(self.levels) - 1, -1, -1):
                most, least = self.levels[depth]
                size = np.maximum(least[node], (4 * s[who] + 4) // 5)
                ok = self._bound(q, who, most, node) >= needed(s[who], size)
                who, node = who[ok], node[ok]
                below = len(self.levels[depth - 1][0]) if depth else len(self.counts)
                child = node[:, None] * FAN_OUT + np.arange(FAN_OUT)
                inside = child < below
                who = np.broadcast_to(who[:, None], child.shape)[inside]
                node = child[inside]
            bound = self._bound(q, who, self.counts, node)
            ok = bound >= needed(s[who], self.sizes[node])
            yield who[ok] + low, self.order[node[ok]], bound[ok]

    @staticmethod
    def _bound(q: np.ndarray, who: np.ndarray, points: np.ndarray, node: np.ndarray) -> np.ndarray:
        out = np.zeros(len(who), np.int64)
        for low in range(0, len(who), 1 << 14):
            part = slice(low, low + (1 << 14))
            out[part] = np.minimum(q[who[part]], points[node[part]]).sum(1, dtype=np.int64)
        return out
