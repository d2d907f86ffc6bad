"""The cutting-stock problem over a histogram of sizes: column generation with a knapsack as pricing step.

Its size is that of the histogram (at most ``capacity`` sizes), whatever the number of items.
"""

from __future__ import annotations

import numpy as np


def best_pattern(value: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity: an unbounded knapsack by dynamic programming."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    by_size, gain = sizes[order], value[order]
    fit = np.searchsorted(by_size, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := fit[room]:
            total = best[room - by_size[:n]] + gain[:n]
            k = int(total.argmax())
            if total[k] > best[room] + 1e-12:
                best[room], pick[room] = total[k], order[k]
    counts = np.zeros(len(sizes), np.int64)
    room = capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            counts[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(best[capacity]), counts


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # einsum stays in this thread; a threaded library would contend with the tasks of a local session
    return np.einsum("ij,jk->ik", a, b)


def solve(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3,
    fill: np.ndarray | None = None, waste: float | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a row each) and how often the linear program uses them, to within ``gap`` of its optimum.

    Revised simplex on "every size is covered at least as often as it is asked for"; a new pattern enters while the
    knapsack finds one worth more than the sequence it costs.

    With ``waste`` an item may also stay without a pattern, for its own share of a sequence times ``1 + waste``. A pattern
    is then used only where it fills more than ``1 / (1 + waste)`` of its sequence; ``fill`` tells the true mean size
    of an item of each size, where sizes are rounded.
    """
    m = len(sizes)
    if not m:
        return np.zeros((0, 0), np.int64), np.zeros(0)
    share = (sizes if fill is None else fill) / capacity
    alone = np.full(m, np.inf) if waste is None else share * (1 + waste)  # what an item costs without a pattern
    basis = np.diag((capacity // sizes).astype(float)) if waste is None else np.eye(m)  # columns
    cost = np.ones(m) if waste is None else alone.copy()
    patterned = np.full(m, waste is None)
    inverse = np.diag(1 / np.diag(basis))
    x = demand / np.diag(basis)
    material = float(share @ demand)  # no plan is shorter
    for step in range(1, 40 * m + 200):
        if step % 500 == 0:  # rounding errors of the updates
            inverse = 2 * inverse - _product(inverse, _product(basis, inverse))
            x = np.maximum(np.einsum("ij,j->i", inverse, demand.astype(float)), 0)
        price = np.einsum("i,ij->j", cost, inverse)
        if price.min() < -1e-9:
            k = int(price.argmin())  # asked for more often than needed: a surplus column
            column, c, new = np.zeros(m), 0.0, False
            column[k] = -1
        elif (price - alone).max() > 1e-9:
            k = int((price - alone).argmax())
            column, c, new = np.zeros(m), alone[k], False
            column[k] = 1
        else:
            worth, counts = best_pattern(np.maximum(price, 0), sizes, capacity)
            used = float(cost @ x)
            if worth <= 1 + 1e-9 or used <= max(material, float(price @ demand) / worth) * (1 + gap):
                break
            column, c, new = counts.astype(float), 1.0, True
        d = np.einsum("ij,j->i", inverse, column)
        up = d > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / d[up]
        out = int(ratio.argmin())
        t = ratio[out]
        x -= t * d
        x[out] = t
        row = inverse[out] / d[out]
        inverse -= np.outer(d, row)
        inverse[out] = row
        basis[:, out], cost[out], patterned[out] = column, c, new
    chosen = patterned & (x > 1e-9)
    return np.rint(basis[:, chosen].T).astype(np.int64), x[chosen]


def rounded(patterns: np.ndarray, x: np.ndarray, demand: np.ndarray) -> tuple[list[tuple[np.ndarray, int]], np.ndarray]:
    """Whole uses of patterns, never more items than there are, and what is left of the demand.

    Uses are rounded to the nearest number as far as items last; what is left is worth fewer sequences than there are
    patterns, about.
    """
    left = demand.astype(np.int64).copy()
    plan = []
    for k in np.argsort(-x, kind="stable"):
        need = patterns[k] > 0
        uses = int(min(np.floor(x[k] + 0.5), (left[need] // patterns[k][need]).min())) if need.any() else 0
        if uses:
            left -= uses * patterns[k]
            plan.append((patterns[k], uses))
    return plan, left
