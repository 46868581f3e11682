"""Gradient-boosted regression trees for two classes, on binned features."""

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """``margin`` gives log odds; ``fit`` grows depth-limited trees on the logistic loss."""

    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    ridge: float = 1.0
    start: float = 0.0
    grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "Boosted":
        share = float(np.clip((y * weight).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3))
        self.start = float(np.log(share / (1 - share)))
        cuts = [self._cuts(column) for column in x.T]
        coded = [
            np.searchsorted(c, column, side="left").astype(np.uint8) for c, column in zip(cuts, x.T)
        ]
        margin = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
            tree, gain = self._grow(coded, cuts, grad, hess)
            self.grown.append(tree)
            margin += gain
        return self

    def _cuts(self, column: np.ndarray) -> np.ndarray:
        """Where a feature may be split; nowhere if it never changes."""
        points = np.unique(np.quantile(column, np.linspace(0, 1, self.bins + 1)[1:-1]))
        return points[points < column.max()] if len(column) else points

    def _grow(self, coded, cuts, grad, hess):
        """The tree, and what it adds to each row's margin."""
        size = (1 << (self.depth + 1)) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        added = np.zeros(len(grad))
        members = {0: np.arange(len(grad))}
        for node in range(size):
            rows = members.pop(node, None)
            if rows is None:
                continue
            grads, hesses = grad[rows], hess[rows]
            g, h = grads.sum(), hesses.sum()
            value[node] = added[rows] = -self.rate * g / (h + self.ridge)
            if 2 * node + 2 >= size or len(rows) < 4:
                continue
            best = (1e-6, -1, 0)
            for k, points in enumerate(cuts):
                if not len(points):
                    continue
                codes = coded[k][rows]
                gl = np.cumsum(np.bincount(codes, grads, len(points) + 1))[:-1]
                hl = np.cumsum(np.bincount(codes, hesses, len(points) + 1))[:-1]
                gain = (gl**2 / (hl + self.ridge) + (g - gl) ** 2 / (h - hl + self.ridge)
                        - g**2 / (h + self.ridge))
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (float(gain[at]), k, at)
            if best[1] >= 0:
                left = coded[best[1]][rows] <= best[2]
                feature[node], cut[node] = best[1], cuts[best[1]][best[2]]
                members[2 * node + 1], members[2 * node + 2] = rows[left], rows[~left]
        return (feature, cut, value), added

    @staticmethod
    def _leaf(x: np.ndarray, tree) -> np.ndarray:
        feature, cut, value = tree
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            split = feature[at]
            inner = split >= 0
            if not inner.any():
                return value[at]
            right = x[np.arange(len(x)), np.maximum(split, 0)] > cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for tree in self.grown:
            total += self._leaf(x, tree)
        return total
