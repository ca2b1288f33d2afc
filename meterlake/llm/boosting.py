"""Gradient boosted trees over bit masks.

Candidates are described by a handful of yes/no features, packed in one long.
All candidates with one mask look alike to a tree, so the table of (mask,
positives, negatives) holds everything that training needs: its size is bounded
by the number of masks, not by the corpus, and the whole corpus is counted in
it. The trees come out as one SQL expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    base: float = 0.0
    # (first bit, bit if set, bit if not, leaves for 11, 10, 01, 00)
    trees: list[tuple[int, int, int, tuple[float, float, float, float]]] = field(default_factory=list)

    def raw(self, mask: np.ndarray) -> np.ndarray:
        out = np.full(len(mask), self.base)
        for a, b, c, (v11, v10, v01, v00) in self.trees:
            on = (mask >> a) & 1 == 1
            out += np.where(on, np.where((mask >> b) & 1 == 1, v11, v10), np.where((mask >> c) & 1 == 1, v01, v00))
        return out

    def sql(self, mask: str) -> str:
        """The raw score as a SQL expression over a column of masks."""
        parts = [f"{self.base!r}D"]
        for a, b, c, (v11, v10, v01, v00) in self.trees:
            parts.append(f"if(({mask} & {1 << a}L) <> 0, if(({mask} & {1 << b}L) <> 0, {v11!r}D, {v10!r}D), "
                         f"if(({mask} & {1 << c}L) <> 0, {v01!r}D, {v00!r}D))")
        return "(" + " + ".join(parts) + ")"


def _leaf(g: float, h: float, l2: float) -> float:
    return g / (h + l2)


def fit(mask: np.ndarray, pos: np.ndarray, neg: np.ndarray, bits: int, rounds: int = 60,
        rate: float = 0.4, l2: float = 1.0) -> Boosted:
    """Logistic loss, second-order gains, trees of depth two."""
    n = pos + neg
    model = Boosted(base=float(np.log((pos.sum() + 1) / (neg.sum() + 1))))
    on = [(mask >> b) & 1 == 1 for b in range(bits)]
    raw = model.raw(mask)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = pos - n * p, n * p * (1 - p)

        def split(rows: np.ndarray) -> tuple[float, int]:
            """Best gain and bit inside ``rows``."""
            best = (0.0, 0)
            for b in range(bits):
                yes, no = rows & on[b], rows & ~on[b]
                gain = sum(g[r].sum() ** 2 / (h[r].sum() + l2) for r in (yes, no)) - g[rows].sum() ** 2 / (h[rows].sum() + l2)
                if gain > best[0] + 1e-9:
                    best = (float(gain), b)
            return best

        gain, a = split(np.ones(len(mask), dtype=bool))
        if gain <= 1e-6:
            break
        b, c = split(on[a])[1], split(~on[a])[1]
        leaves = tuple(round(rate * _leaf(float(g[r].sum()), float(h[r].sum()), l2), 6) for r in
                       (on[a] & on[b], on[a] & ~on[b], ~on[a] & on[c], ~on[a] & ~on[c]))
        model.trees.append((a, b, c, leaves))
        raw = model.raw(mask)
    return model


def threshold(raw: np.ndarray, pos: np.ndarray, neg: np.ndarray, precision: float) -> float:
    """The least raw score from which on isotonic calibration gives at least
    ``precision``; infinity if no score does."""
    order = np.argsort(raw, kind="stable")
    # pool adjacent violators: blocks of (positives, rows, least score)
    blocks: list[list[float]] = []
    for i in order:
        blocks.append([float(pos[i]), float(pos[i] + neg[i]), float(raw[i])])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p, n, _ = blocks.pop()
            blocks[-1][0] += p
            blocks[-1][1] += n
    for p, n, least in blocks:
        if n and p / n >= precision:
            return least
    return float("inf")
