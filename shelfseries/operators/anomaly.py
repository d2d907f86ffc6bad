"""Vote of three anomaly detectors over panels."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import flag
from . import kpi, quality
from .packing import pack_rows
from .windows import centred_bands, cols, per_period, top_rows, z_scores

TREES = 100
SAMPLE = 256
SEED = 42
EULER = 0.5772156649015329


def _path_norm(n: np.ndarray) -> np.ndarray:
    """Expected path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def _isolation_scores(y: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Raw isolation score of each value (close to -1 = easily isolated).

    On one feature a tree is a step function of the value, so a node is a range
    of the sorted values. All trees grow together, one level at a time.
    """
    n = len(y)
    size = min(SAMPLE, n)
    depth_limit = math.ceil(math.log2(max(size, 2)))
    values = np.sort(y)
    if size < n:
        picks = np.sort(np.argsort(rng.random((TREES, n)), axis=1)[:, :size], axis=1)
    else:
        picks = np.broadcast_to(np.arange(n), (TREES, n))
    # drawn[t, j]: how many of the j smallest values tree t has drawn
    drawn = np.zeros((TREES, n + 1), dtype=np.int64)
    np.put_along_axis(drawn, picks + 1, 1, axis=1)
    drawn = drawn.cumsum(axis=1)
    tree, start, stop = np.arange(TREES), np.zeros(TREES, dtype=np.int64), np.full(TREES, n)
    leaves = []
    for level in range(depth_limit + 1):
        first, last = drawn[tree, start], drawn[tree, stop] - 1
        count = last - first + 1
        low = values[picks[tree, np.minimum(first, size - 1)]]
        high = values[picks[tree, np.maximum(last, 0)]]
        leaf = (count <= 1) | (low == high) | (level == depth_limit)
        leaves.append(np.column_stack(
            [tree[leaf], start[leaf], stop[leaf] - start[leaf], level + _path_norm(count[leaf])]
        ))
        if leaf.all():
            break
        tree, start, stop, low, high = (a[~leaf] for a in (tree, start, stop, low, high))
        cut = low + rng.random(len(tree)) * (high - low)
        middle = np.searchsorted(values, cut, side="right")
        tree = np.concatenate([tree, tree])
        start, stop = np.concatenate([start, middle]), np.concatenate([middle, stop])
    table = np.vstack(leaves)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    depth = np.repeat(table[:, 3], table[:, 2].astype(np.int64)).reshape(TREES, n)
    raw = -np.exp2(-depth.mean(axis=0) / max(float(_path_norm(size)), 1e-12))
    return raw[np.searchsorted(values, y)]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _forest_batch(series: pd.Series, seeds: pd.Series) -> pd.Series:
    """Raw isolation scores per series; null where a series cannot be scored."""
    out = []
    for y, seed in zip(series, seeds):
        values = np.asarray(y, dtype=float)
        if len(values) == 0 or not np.isfinite(values).all():
            out.append(None)
        else:
            rng = np.random.default_rng([SEED, int(seed) & 0x7FFFFFFFFFFFFFFF])
            out.append(_isolation_scores(values, rng).tolist())
    return pd.Series(out)


def _offset(contamination: float) -> Column:
    """The ``contamination`` quantile of the array ``raw`` (null when there are no scores)."""
    ranked = F.array_sort("raw")
    spot = F.lit(float(contamination)) * (F.size("raw") - 1)
    low = F.element_at(ranked, F.floor(spot).cast("int") + 1)
    high = F.element_at(ranked, F.ceil(spot).cast("int") + 1)
    return F.when(F.col("raw").isNotNull(), low + (high - low) * (spot - F.floor(spot)))


def _with_raw_scores(
    panel: DataFrame, keys: tuple[str, ...], contaminations: list[float], date_col: str, value_col: str,
) -> DataFrame:
    """The rows of the panel with their raw score ``_raw`` and an offset ``_o<i>`` per contamination.

    The trees of a series are seeded by its keys, so the result does not depend
    on partitioning or input order.
    """
    seed = F.xxhash64(*cols(keys)) if keys else F.lit(0).cast("long")
    values = F.transform("obs", lambda o: o[value_col].cast("double"))
    packed = pack_rows(panel, keys, date_col).withColumn("raw", _forest_batch(values, seed))
    offsets = [_offset(c).alias(f"_o{i}") for i, c in enumerate(contaminations)]
    rows = packed.select(*cols(keys), *offsets, F.explode(F.arrays_zip("obs", "raw")).alias("o"))
    names = [c for c in panel.columns if c not in keys]
    return rows.select(
        *cols(keys), *[F.col("o.obs")[c].alias(c) for c in names],
        *[f"_o{i}" for i in range(len(contaminations))], F.col("o.raw").alias("_raw"),
    )


def _forest_columns(i: int) -> tuple[Column, Column]:
    """Flag and score under the i-th offset; a series that cannot be scored gets 0 and 0."""
    margin = F.col("_raw") - F.col(f"_o{i}")
    return flag(margin < 0).alias("Anomaly_IForest"), F.coalesce(margin, F.lit(0.0)).alias("IForest_Score")


def forest_scores(
    panel: DataFrame, keys: tuple[str, ...] = (), contamination: float = 0.03,
    date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """The panel with IForest_Score and Anomaly_IForest.

    The score is the raw isolation score less its ``contamination`` quantile in
    the series, so the flag is score < 0.
    """
    scored = _with_raw_scores(panel, keys, [contamination], date_col, value_col)
    return scored.select(*[F.col(f"`{c}`") for c in panel.columns], *_forest_columns(0))


def _vote(df: DataFrame) -> DataFrame:
    votes = F.col("Anomaly_Z") + F.col("Anomaly_Rolling") + F.col("Anomaly_IForest")
    return df.withColumn("Anomaly_Vote_Count", votes).withColumn("Is_Anomaly", flag(votes >= 2))


def detect_anomalies(
    panel: DataFrame,
    keys: tuple[str, ...] = (),
    contamination: float = 0.03,
    rolling_window: int = 8,
    rolling_k: float = 2.0,
    z_threshold: float = 2.0,
    date_col: str = "Date",
    value_col: str = "Sales",
) -> DataFrame:
    """All rows of the panel with three detector flags, their vote and the consensus (2 of 3).

    The windows come first and the packed series last: both need the rows
    partitioned by the keys, so the whole detector costs one shuffle.
    """
    quality.require_columns(panel, [*keys, date_col, value_col])
    extra = [c for c in panel.columns if c not in (*keys, date_col, value_col)]
    flags = statistical_flags(panel, keys, rolling_window, rolling_k, z_threshold, date_col, value_col)
    return _vote(forest_scores(flags, keys, contamination, date_col, value_col)).select(
        *cols(keys), date_col, value_col, *cols(tuple(extra)), "Z_Score", "Anomaly_Z", "Rolling_Mean", "Rolling_Std",
        "Anomaly_Rolling", "Anomaly_IForest", "IForest_Score", "Anomaly_Vote_Count", "Is_Anomaly",
    )


def anomalies_only(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("Is_Anomaly") == 1)


def detect_under_settings(
    panel: DataFrame, settings: list[dict], keys: tuple[str, ...] = (), date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """The detector under several threshold sets in one job.

    ``settings`` holds the arguments of ``detect_anomalies`` under a ``name``.
    Forest scores, z-scores and each distinct rolling size do not depend on the
    thresholds, so they are computed once and only the comparisons are repeated.
    """
    defaults = {"contamination": 0.03, "rolling_window": 8, "rolling_k": 2.0, "z_threshold": 2.0}
    sets = [{**defaults, **s} for s in settings]
    rows = z_scores(per_period(panel, keys, date_col, value_col), keys, value_col=value_col).drop("Anomaly_Z")
    for size in sorted({s["rolling_window"] for s in sets}):
        rows = (
            centred_bands(rows, keys, size, 0.0, date_col, value_col).drop("Anomaly_Rolling")
            .withColumnsRenamed({"Rolling_Mean": f"_m{size}", "Rolling_Std": f"_s{size}"})
        )
    rows = _with_raw_scores(rows, keys, [s["contamination"] for s in sets], date_col, value_col)
    v = F.col(f"`{value_col}`")
    variants = []
    for i, s in enumerate(sets):
        mean, spread = F.col(f"_m{s['rolling_window']}"), F.col(f"_s{s['rolling_window']}")
        outside = (v > mean + s["rolling_k"] * spread) | (v < mean - s["rolling_k"] * spread)
        variants.append(F.struct(
            F.lit(s["name"]).alias("setting"),
            flag(F.abs("Z_Score") > s["z_threshold"]).alias("Anomaly_Z"),
            mean.alias("Rolling_Mean"), spread.alias("Rolling_Std"),
            flag(outside).alias("Anomaly_Rolling"),
            *_forest_columns(i),
        ))
    chosen = rows.select(*cols(keys), date_col, value_col, "Z_Score", F.explode(F.array(*variants)).alias("t"))
    return _vote(chosen.select(*cols(keys), date_col, value_col, "Z_Score", "t.*"))


def winsorize_flagged(
    flagged: DataFrame, k: float = 2.0, flag_col: str = "Is_Anomaly", value_col: str = "Sales",
) -> DataFrame:
    """Sales of flagged periods held at or below the rolling mean plus k deviations, as Sales_Winsorized."""
    v = F.col(f"`{value_col}`")
    ceiling = F.col("Rolling_Mean") + k * F.col("Rolling_Std")
    return flagged.withColumn("Sales_Winsorized", F.when(F.col(flag_col) == 1, F.least(v, ceiling)).otherwise(v))


def statistical_flags(
    panel: DataFrame, keys: tuple[str, ...] = (), rolling_window: int = 8, rolling_k: float = 2.0,
    z_threshold: float = 2.0, date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """The z-score and rolling detectors alone, all in windows."""
    checked = per_period(panel, keys, date_col, value_col)
    return centred_bands(
        z_scores(checked, keys, z_threshold, value_col), keys, rolling_window, rolling_k, date_col, value_col
    )


def audit_log(flagged: DataFrame, keys: tuple[str, ...] = (), date_col: str = "Date", value_col: str = "Sales") -> DataFrame:
    """Display table of the consensus anomalies."""
    return anomalies_only(flagged).select(
        *cols(keys),
        F.date_format(F.col(f"`{date_col}`"), "yyyy-MM-dd").alias("Date"),
        F.col(f"`{value_col}`").alias("Sales ($)"),
        F.col("Rolling_Mean").alias("Local Average ($)"),
        F.col("Z_Score"),
        F.col("Anomaly_Vote_Count").alias("Ensemble Vote Score (Max 3)"),
    )


def largest_anomalies(flagged: DataFrame, k: int = 10, keys: tuple[str, ...] = ()) -> DataFrame:
    """The k largest consensus anomalies by sales, overall or per series."""
    return top_rows(anomalies_only(flagged), k, "Sales", keys)


anomaly_kpis = kpi.anomaly_kpis
