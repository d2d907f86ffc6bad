"""Boosted regression trees on lags and calendar, with a recursive forecast.

``boosted_batch`` grows the trees of many series at once: each level of each
tree is one histogram over (series, node, feature, bin). ``pooled_boosting``
trains one MLlib model over the whole panel instead.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators.windows import cols, lagged, last_values
from ..sources.staging import hold

TREES, DEPTH, RATE, LAGS = 100, 4, 0.05, 3
LEAF_PENALTY = 1.0
MIN_CHILD = 1.0
Z95 = 1.96
SEED = 42


def _features(y: np.ndarray, month: np.ndarray) -> np.ndarray:
    """(B, n - LAGS, LAGS + 2) lags, month and quarter for the rows with a full history."""
    n = y.shape[1]
    lags = [y[:, LAGS - i:n - i] for i in range(1, LAGS + 1)]
    m = np.broadcast_to(month[LAGS:n], lags[0].shape)
    return np.stack([*lags, m, (m - 1) // 3 + 1], axis=2).astype(np.float64)


def _bins(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each value among the distinct values of its feature, and the value of each rank."""
    count, n, width = x.shape
    rank = np.zeros(x.shape, dtype=np.int64)
    edge = np.full((count, width, n), np.inf)
    order = np.argsort(x, axis=1, kind="stable")
    ordered = np.take_along_axis(x, order, axis=1)
    fresh = np.concatenate([np.zeros((count, 1, width), dtype=np.int64),
                            (np.diff(ordered, axis=1) > 0).astype(np.int64)], axis=1).cumsum(axis=1)
    np.put_along_axis(rank, order, fresh, axis=1)
    b, _, f = np.indices(x.shape)
    edge[b, f, fresh] = ordered
    return rank, edge


def _grow(rank: np.ndarray, edge: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree per series: split feature and threshold (value < threshold goes left), leaf values, leaf of each row."""
    count, n, width = rank.shape
    nodes = 2 ** (DEPTH + 1) - 1
    feature = np.full((count, nodes), -1)
    threshold = np.full((count, nodes), np.inf)
    value = np.zeros((count, nodes))
    place = np.zeros((count, n), dtype=np.int64)
    series = np.arange(count)[:, None]
    for level in range(DEPTH + 1):
        first, wide = 2**level - 1, 2**level
        local = place - first
        live = local >= 0
        cell = (series * wide + np.where(live, local, 0))
        g = np.bincount(cell.ravel(), np.where(live, gradient, 0.0).ravel(), count * wide).reshape(count, wide)
        h = np.bincount(cell.ravel(), live.ravel().astype(float), count * wide).reshape(count, wide)
        value[:, first:first + wide] = -g / (h + LEAF_PENALTY) * RATE
        if level == DEPTH:
            break
        slot = (cell[:, :, None] * width + np.arange(width)) * n + rank
        mass = np.broadcast_to(live[:, :, None], slot.shape).astype(float)
        shape = (count, wide, width, n)
        gl = np.bincount(slot.ravel(), (mass * gradient[:, :, None]).ravel(), count * wide * width * n)
        hl = np.bincount(slot.ravel(), mass.ravel(), count * wide * width * n)
        gl, hl = gl.reshape(shape).cumsum(axis=3), hl.reshape(shape).cumsum(axis=3)
        gr, hr = g[:, :, None, None] - gl, h[:, :, None, None] - hl
        gain = gl**2 / (hl + LEAF_PENALTY) + gr**2 / (hr + LEAF_PENALTY) - (g**2 / (h + LEAF_PENALTY))[:, :, None, None]
        gain = np.where((hl >= MIN_CHILD) & (hr >= MIN_CHILD), gain, -np.inf)
        # equal splits of different features differ by rounding only: the first one wins
        flat = gain.reshape(count, wide, width * n)
        top = flat.max(axis=2)
        tolerance = 1e-9 * np.abs(np.where(np.isfinite(top), top, 0.0))
        pick = np.argmax(flat >= (top - tolerance)[:, :, None], axis=2)
        chosen, cut = pick // n, pick % n
        split = top > 1e-6
        feature[:, first:first + wide] = np.where(split, chosen, -1)
        row_split = np.take_along_axis(split, np.where(live, local, 0), axis=1) & live
        row_feature = np.take_along_axis(chosen, np.where(live, local, 0), axis=1)
        row_cut = np.take_along_axis(cut, np.where(live, local, 0), axis=1)
        row_rank = np.take_along_axis(rank, row_feature[:, :, None], axis=2)[:, :, 0]
        # the threshold is the smallest value of the feature that goes right
        right = row_rank > row_cut
        node_feature_edge = edge[np.arange(count)[:, None], chosen, np.minimum(cut + 1, n - 1)]
        threshold[:, first:first + wide] = np.where(split, node_feature_edge, np.inf)
        place = np.where(row_split, 2 * place + 1 + right, place)
    return feature, threshold, value, place


def _walk(tree: tuple, x: np.ndarray) -> np.ndarray:
    """Leaf value of (B, features) rows."""
    feature, threshold, value = tree[:3]
    index = np.arange(len(x))
    place = np.zeros(len(x), dtype=np.int64)
    for _ in range(DEPTH):
        f = feature[index, place]
        go_right = x[index, np.maximum(f, 0)] >= threshold[index, place]
        place = np.where(f >= 0, 2 * place + 1 + go_right, place)
    return value[index, place]


def boosted_fit(y: np.ndarray, start: np.datetime64) -> np.ndarray:
    """(B, m) fitted models of (B, n) monthly series: base, residual deviation, last values, and all nodes of all trees."""
    n = y.shape[1]
    if n <= LAGS:
        raise ValueError(f"needs more than {LAGS} months, has {n}")
    month = (start.astype("datetime64[M]").astype(int) + np.arange(n)) % 12 + 1
    x, target = _features(y, month), y[:, LAGS:]
    rank, edge = _bins(x)
    base = target.mean(axis=1)
    fitted = np.repeat(base[:, None], target.shape[1], axis=1)
    nodes = []
    for _ in range(TREES):
        tree = _grow(rank, edge, fitted - target)
        fitted = fitted + np.take_along_axis(tree[2], tree[3], axis=1)
        nodes.append(np.stack(tree[:3], axis=1).astype(float))
    return np.column_stack([base, np.std(target - fitted, axis=1), y[:, -LAGS:], np.stack(nodes, axis=1).reshape(len(y), -1)])


def boosted_predict(fitted: np.ndarray, start: np.datetime64, n: int, horizon: int):
    """Recursive forecast and bounds (1.96 training-residual deviations)."""
    month = (start.astype("datetime64[M]").astype(int) + np.arange(n, n + horizon)) % 12 + 1
    base, spread, recent = fitted[:, 0], Z95 * fitted[:, 1], fitted[:, 2:2 + LAGS]
    nodes = fitted[:, 2 + LAGS:].reshape(len(fitted), TREES, 3, -1)
    trees = [(nodes[:, k, 0].astype(np.int64), nodes[:, k, 1], nodes[:, k, 2]) for k in range(TREES)]
    mean = np.zeros((len(fitted), horizon))
    for h in range(horizon):
        m = float(month[h])
        row = np.column_stack([recent[:, ::-1], np.full(len(fitted), m), np.full(len(fitted), (m - 1) // 3 + 1)])
        mean[:, h] = np.maximum(base + sum(_walk(tree, row) for tree in trees), 0.0)
        recent = np.column_stack([recent[:, 1:], mean[:, h]])
    return mean, np.maximum(mean - spread[:, None], 0.0), mean + spread[:, None]


def boosted_batch(y: np.ndarray, start: np.datetime64, horizon: int):
    """Fit and forecast of (B, n) monthly series at once."""
    return boosted_predict(boosted_fit(y, start), start, y.shape[1], horizon)


def pooled_boosting(
    panel: DataFrame, keys: tuple[str, ...] = (), horizon: int = 3, date_col: str = "Date", value_col: str = "Sales",
    trees: int = TREES,
) -> DataFrame:
    """Forecast of every series from one MLlib model trained over the whole panel.

    Values are divided by the mean of their series so that series of any size
    share the trees; the keys enter as indexed features. Each step of the
    recursion shifts the lag columns, so the plan stays narrow. The panel, the
    training rows and the state before the first step are held: training, residuals
    and every step read them and not the transactions.
    """
    if not keys:
        # a constant key, so that one series takes the same path as many
        return pooled_boosting(panel.withColumn("_series", F.lit("all")), ("_series",), horizon, date_col, value_col, trees).drop("_series")
    panel = hold(panel.select(*cols(keys), F.col(f"`{date_col}`"), F.col(f"`{value_col}`")), "pooled-panel")
    mean = panel.groupBy(*cols(keys)).agg(F.avg(F.col(f"`{value_col}`")).alias("_mean"))
    unit = F.when(F.col("_mean") > 0, F.col("_mean")).otherwise(F.lit(1.0))

    def with_unit(df: DataFrame) -> DataFrame:
        return df.join(mean, list(keys)).withColumn("_unit", unit).drop("_mean")

    d = F.col(f"`{date_col}`")
    lag_names = [f"lag_{i}" for i in range(1, LAGS + 1)]
    indexed = [f"_key{i}" for i in range(len(keys))]
    calendar_cols = {"_month": F.month(d).cast("double"), "_quarter": F.quarter(d).cast("double")}
    scaled = with_unit(panel).withColumn("_y", F.col(f"`{value_col}`") / F.col("_unit"))
    train = hold(lagged(scaled, keys, LAGS, date_col, "_y").withColumns(calendar_cols), "pooled-train")
    stages = [
        *[StringIndexer(inputCol=k, outputCol=i, handleInvalid="keep") for k, i in zip(keys, indexed)],
        VectorAssembler(inputCols=[*lag_names, "_month", "_quarter", *indexed], outputCol="features"),
        GBTRegressor(featuresCol="features", labelCol="_y", predictionCol="_p", maxIter=trees, maxDepth=DEPTH,
                     stepSize=RATE, seed=SEED, maxBins=256),
    ]
    model = Pipeline(stages=stages).fit(train)
    residual = model.transform(train).groupBy(*cols(keys)).agg(
        F.stddev_pop((F.col("_y") - F.col("_p")) * F.col("_unit")).alias("_spread")
    )
    recent = with_unit(last_values(panel, keys, LAGS, date_col, value_col))
    lag_at = [
        F.max(F.when(F.col("recency") == i, F.col(f"`{value_col}`") / F.col("_unit"))).alias(f"lag_{i}")
        for i in range(1, LAGS + 1)
    ]
    state = recent.groupBy(*cols(keys)).agg(
        F.max(d).alias("_last"), F.first("_unit").alias("_unit"), *lag_at
    ).withColumn(
        date_col, cal.next_month("_last")
    )
    state = hold(state.join(residual, list(keys)), "pooled-state")
    steps = []
    for step in range(1, horizon + 1):
        predicted = model.transform(state.withColumns(calendar_cols)).withColumn("_p", F.greatest("_p", F.lit(0.0)))
        value = F.col("_p") * F.col("_unit")
        steps.append(predicted.select(
            *cols(keys), F.lit("PooledBoosting").alias("Model"), F.lit(step).alias("step"), d,
            value.alias("Forecast"),
            F.greatest(value - Z95 * F.col("_spread"), F.lit(0.0)).alias("Lower_CI"),
            (value + Z95 * F.col("_spread")).alias("Upper_CI"),
        ))
        shifted = {f"lag_{i}": F.col(f"lag_{i - 1}") for i in range(2, LAGS + 1)}
        state = predicted.withColumns({**shifted, "lag_1": F.col("_p"), date_col: cal.next_month(date_col)}).select(
            *cols(keys), "_unit", "_spread", date_col, *lag_names
        )
    out = steps[0]
    for more in steps[1:]:
        out = out.unionByName(more)
    return out
