"""The cutting-stock plan of packing: which lengths share a sequence, and how often.

A linear program over patterns (how many pieces of each length class fill a sequence), solved by
column generation: the simplex holds one pattern per class, and a knapsack by dynamic
programming finds the pattern that its prices value most.  All of it has the size of the
histogram, whatever the number of documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: The plan is good enough when it uses at most this share more sequences than the bound of its prices.
GAP = 5e-4


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences, each with ``counts[c]`` pieces of class c."""

    times: int
    counts: dict[int, int]


def best_pattern(value: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The knapsack: the greatest sum of values in ``room`` and how often each size is in it."""
    use = np.flatnonzero(value > 1e-12)
    use = use[np.argsort(size[use])]
    value, fits = value[use], np.searchsorted(size[use], np.arange(room + 1), side="right")
    sizes = size[use]
    best, chosen = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        k = fits[c]
        if k:
            total = best[c - sizes[:k]] + value[:k]
            i = int(total.argmax())
            if total[i] > best[c] + 1e-12:
                best[c], chosen[c] = total[i], i
    counts, c = np.zeros(len(size), np.int64), room
    while c > 0:
        if chosen[c] < 0:
            c -= 1
        else:
            counts[use[chosen[c]]] += 1
            c -= sizes[chosen[c]]
    return float(best[room]), counts


def solve(size: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as rows, times as fractions) that hold all pieces in the fewest sequences."""
    m = len(size)
    alone = room // size
    columns, cost = np.diag(alone).astype(float), np.ones(m)
    inverse, x = np.diag(1.0 / alone), demand / alone
    low = float(size @ demand) / room
    for _ in range(60 * m + 100):
        price = cost @ inverse
        worst = int(price.argmin())
        if price[worst] < -1e-9:  # more pieces than there are: leaving one out is free
            column, own = np.zeros(m), 0.0
            column[worst] = -1.0
        else:
            value, counts = best_pattern(price, size, room)
            total = float(cost @ x)
            low = max(low, total / value)
            if value <= 1 + 1e-9 or total <= low * (1 + gap):
                break
            column, own = counts.astype(float), 1.0
        change = inverse @ column
        up = change > 1e-9
        ratio = np.where(up, x / np.where(up, change, 1.0), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        x = np.maximum(x - step * change, 0.0)
        x[out] = step
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
        columns[:, out], cost[out] = column, own
    used = cost > 0
    return columns[:, used].T.astype(np.int64), x[used]


def patterns(size: np.ndarray, demand: np.ndarray, room: int, least_fill: float) -> list[Pattern]:
    """The plan rounded down, fullest patterns first.  Patterns filled to less than ``least_fill``
    are left out; no class is used more often than it has pieces."""
    have = demand > 0
    if not have.any():
        return []
    rows, times = solve(size[have], demand[have].astype(float), room)
    where, fill = np.flatnonzero(have), rows @ size[have]
    left, plan = demand.astype(np.int64).copy(), []
    for i in np.argsort(-fill, kind="stable").tolist():
        counts = {int(where[c]): int(rows[i, c]) for c in np.flatnonzero(rows[i])}
        n = min([int(times[i] + 1e-6), *[int(left[c]) // a for c, a in counts.items()]])
        if n > 0 and fill[i] >= least_fill * room:
            plan.append(Pattern(n, counts))
            for c, a in counts.items():
                left[c] -= n * a
    return plan
