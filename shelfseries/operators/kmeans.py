"""Many k-means fits over one table, side by side.

Choosing k takes several starts for every k. Fitted one after the other, each
would scan the points once per iteration. Here one job per iteration serves all
fits: tasks assign their rows to the centres of every fit and return only sums
per centre, which Spark adds up; the driver sees centres, never points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOLERANCE = 1e-4
MAX_STEPS = 100
#: Rounds of oversampling after the first, candidates a round adds per centre asked for, and refinements of the candidates.
ROUNDS, OVERSAMPLE, REFINEMENTS = 4, 2, 30


def _unit(x: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) per row from its values and the salt, whatever partition the row is in."""
    h = np.full(len(x), salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for column in (x + 0.0).T:  # + 0.0: a negative zero is a zero
        h ^= np.ascontiguousarray(column).view(np.uint64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    return ((h >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def _draw(points: DataFrame, columns: list[str], known: list[np.ndarray], count: int, seed: int, turn: int) -> list[np.ndarray]:
    """One job: per start ``count`` rows drawn without replacement by their squared distance to the centres ``known`` so far
    (all rows alike without any).

    Keys ``-ln(u) / distance`` make the draw a smallest-keys list: tasks send their own, the driver keeps the least of all.
    """
    width = len(columns)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [np.empty((0, width + 1)) for _ in known]
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            square = np.sum(x**2, axis=1)
            for i, centres in enumerate(known):
                weight = np.ones(len(x))
                if len(centres):
                    weight = np.maximum((np.sum(centres**2, axis=1)[None, :] - 2.0 * x @ centres.T).min(axis=1) + square, 0.0)
                open_ = weight > 0
                key = -np.log(_unit(x[open_], (seed << 16) + (turn << 8) + i)) / weight[open_]
                both = np.concatenate([best[i], np.column_stack([key, x[open_]])])
                best[i] = both[np.lexsort(both.T[::-1])][:count]
        frame = pd.DataFrame(np.concatenate(best), columns=["key", *[f"x{j}" for j in range(width)]])
        frame.insert(0, "start", np.repeat(np.arange(len(known)), [len(b) for b in best]))
        yield frame

    names = ["key", *[f"x{j}" for j in range(width)]]
    drawn = points.select(*columns).mapInPandas(nearest, "start long, " + ", ".join(f"{f} double" for f in names))
    place = F.row_number().over(Window.partitionBy("start").orderBy(*names))
    rows = drawn.withColumn("place", place).where(F.col("place") <= count).toPandas()
    return [rows[rows.start == i].sort_values(names)[names[1:]].to_numpy(dtype=float) for i in range(len(known))]


def _candidates(points: DataFrame, columns: list[str], k: int, starts: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per start candidate centres from all rows and how many rows are nearest to each (k-means||).

    A round adds ``OVERSAMPLE * k`` rows that lie far from those chosen, for all starts in one job; a last job counts. The
    driver sees ``(ROUNDS + 1) * OVERSAMPLE * k`` rows per start, whatever the size of the table.
    """
    known = [np.empty((0, len(columns)))] * starts
    for turn in range(ROUNDS + 1):
        fresh = _draw(points, columns, known, OVERSAMPLE * k, seed, turn)
        known = [np.unique(np.concatenate([a, b]), axis=0) for a, b in zip(known, fresh)]
    if not len(known[0]):
        raise ValueError("there are no points to cluster")
    sums, _ = _pass_over(points, columns, dict(enumerate(known)))
    return [(known[i], sums[i][:, 0]) for i in range(starts)]


def _spread_centres(rows: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the weighted rows as k-means++ draws them, the best of a few candidates each, then refined over the rows."""
    centres = rows[[rng.choice(len(rows), p=weight / weight.sum())]]
    nearest = np.sum((rows - centres[0]) ** 2, axis=1)
    while len(centres) < k:
        mass = nearest * weight
        options = rng.choice(len(rows), size=2 + int(np.log(k)), p=mass / mass.sum() if mass.sum() > 0 else None)
        reach = np.minimum(nearest, ((rows[options][:, None, :] - rows[None, :, :]) ** 2).sum(axis=2))
        best = int(np.argmin(reach @ weight))
        centres = np.vstack([centres, rows[options[best]]])
        nearest = reach[best]
    for _ in range(REFINEMENTS):
        own = np.argmin(((rows[:, None, :] - centres[None]) ** 2).sum(axis=2), axis=1)
        size = np.bincount(own, weight, k)
        moved = np.column_stack([np.bincount(own, weight * column, k) for column in rows.T]) / np.maximum(size, 1e-300)[:, None]
        moved = np.where(size[:, None] > 0, moved, centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def _pass_over(points: DataFrame, columns: list[str], fits: dict[int, np.ndarray]) -> tuple[dict, dict]:
    """One job: per fit the row counts and coordinate sums of its centres, and its cost."""
    names = list(fits)
    centres = np.vstack([fits[i] for i in names])
    ends = np.cumsum([len(fits[i]) for i in names])
    starts = ends - [len(fits[i]) for i in names]
    width = len(columns)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(centres), width + 2))
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            square = np.sum(x**2, axis=1)
            distance = np.sum(centres**2, axis=1)[None, :] - 2.0 * x @ centres.T
            for a, b in zip(starts, ends):
                own = np.argmin(distance[:, a:b], axis=1)
                cost = np.maximum(distance[np.arange(len(x)), a + own] + square, 0.0)
                total[a:b, 0] += np.bincount(own, minlength=b - a)
                total[a:b, 1] += np.bincount(own, cost, minlength=b - a)
                for j in range(width):
                    total[a:b, 2 + j] += np.bincount(own, x[:, j], minlength=b - a)
        used = total[:, 0] > 0
        frame = pd.DataFrame(total[used], columns=["n", "cost", *[f"s{j}" for j in range(width)]])
        frame.insert(0, "centre", np.flatnonzero(used))
        yield frame

    fields = ["n", "cost", *[f"s{j}" for j in range(width)]]
    schema = "centre long, " + ", ".join(f"{f} double" for f in fields)
    rows = (
        points.select(*columns).mapInPandas(partial, schema)
        .groupBy("centre").agg(*[F.sum(f).alias(f) for f in fields]).collect()
    )
    table = np.zeros((len(centres), width + 2))
    for r in rows:
        table[r["centre"]] = [r[f] for f in fields]
    parts = {i: table[a:b] for i, a, b in zip(names, starts, ends)}
    return {i: t[:, [0, *range(2, width + 2)]] for i, t in parts.items()}, {i: float(t[:, 1].sum()) for i, t in parts.items()}


def fit_many(
    points: DataFrame, columns: list[str], ks: list[int], starts: int, seed: int,
) -> dict[int, tuple[np.ndarray, float]]:
    """For each k the centres and inertia of its cheapest start."""
    pools = _candidates(points, columns, max(ks), starts, seed)
    tasks = [(k, s) for k in ks for s in range(starts)]
    fits = {
        i: _spread_centres(*pools[s], min(k, len(pools[s][0])), np.random.default_rng([seed, k, s]))
        for i, (k, s) in enumerate(tasks)
    }
    rows, weight = pools[0]
    middle = np.average(rows, axis=0, weights=weight)
    tolerance = TOLERANCE * float(np.mean(np.average((rows - middle) ** 2, axis=0, weights=weight)))
    moving = set(fits)
    for _ in range(MAX_STEPS):
        sums, _ = _pass_over(points, columns, {i: fits[i] for i in sorted(moving)})
        for i, table in sums.items():
            count = table[:, :1]
            # a centre without rows stays where it is
            new = np.where(count > 0, table[:, 1:] / np.maximum(count, 1.0), fits[i])
            if np.sum((new - fits[i]) ** 2) <= tolerance:
                moving.discard(i)
            fits[i] = new
        if not moving:
            break
    _, costs = _pass_over(points, columns, fits)
    best: dict[int, tuple[np.ndarray, float]] = {}
    for i, (k, _) in enumerate(tasks):
        if k not in best or costs[i] < best[k][1]:
            best[k] = (fits[i], costs[i])
    return best


def nearest_centre(columns: list[str], centres: np.ndarray) -> Column:
    """Index of the closest centre, as a built-in expression."""
    distances = []
    for centre in centres:
        terms = [(F.col(c) - float(x)) * (F.col(c) - float(x)) for c, x in zip(columns, centre)]
        distances.append(sum(terms[1:], terms[0]))
    return (F.array_position(F.array(*distances), F.array_min(F.array(*distances))) - 1).cast("int")
