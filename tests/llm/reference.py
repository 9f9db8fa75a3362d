"""The language model in memory, as the tests' reference."""

import numpy as np

from tastemap.llm import words as W
from tastemap.llm.perplexity import ORDER


class Model:
    """One language's model: for each order the sorted n-grams with their interpolated
    probability, and the sorted contexts with their back-off weight."""

    def __init__(self, grams_: np.ndarray, counts: np.ndarray, top: int = ORDER):
        key, at = np.unique(grams_ & W.U((1 << 8 * top) - 1), return_inverse=True)
        cnt = np.bincount(at, counts).astype(np.float64)
        levels = []
        for n in range(top, 0, -1):
            levels.append((n, key, cnt))
            # continuation counts: how many different n-grams end in this (n-1)-gram
            key, types = np.unique(key & W.U((1 << 8 * (n - 1)) - 1), return_counts=True)
            cnt = types.astype(np.float64)
        self.floor = 1.0 / 256
        lower = None
        self.levels = []
        for n, key, cnt in reversed(levels):
            d = _discounts(cnt)
            use = d[np.minimum(cnt, 3).astype(int)]
            ctx, at = np.unique(key >> W.U(8), return_inverse=True)
            total = np.bincount(at, cnt)
            gamma = np.bincount(at, use) / total
            base = self.floor if lower is None else lower(key & W.U((1 << 8 * (n - 1)) - 1))
            p = (cnt - use) / total[at] + gamma[at] * base
            self.levels.append((n, key, p, ctx, gamma))
            lower = self.probability if n < top else None
        self.levels.reverse()  # highest order first

    def probability(self, g: np.ndarray) -> np.ndarray:
        """Interpolated probability of the last byte of each n-gram, at the highest built order."""
        built = sorted(self.levels, key=lambda x: -x[0])
        out = np.zeros(len(g))
        weight = np.ones(len(g))
        open_ = np.arange(len(g))
        for n, key, p, ctx, gamma in built:
            k = g[open_] & W.U((1 << 8 * n) - 1)
            at, hit = _find(key, k)
            out[open_[hit]] = weight[open_[hit]] * p[at[hit]]
            open_, k = open_[~hit], k[~hit]
            at, known = _find(ctx, k >> W.U(8))
            weight[open_[known]] *= gamma[at[known]]
        out[open_] = weight[open_] * self.floor
        return out


def _find(sorted_: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_, k), len(sorted_) - 1)
    return at, sorted_[at] == k


def _discounts(cnt: np.ndarray) -> np.ndarray:
    """D(0), D1, D2, D3+ from the counts of counts."""
    n1, n2, n3, n4 = (float(np.sum(cnt == i)) for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9]
    return np.array([min(max(x, 0.05), i - 0.05) if i else 0.0 for i, x in enumerate(d)])
