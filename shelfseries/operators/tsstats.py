"""Stationarity, decomposition and autocorrelation of panels."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .packing import pack
from .windows import cols, ordered

# MacKinnon's published response surfaces for the Dickey-Fuller
# t statistic with a constant (p-value, 1994; critical values, 2010).
TAU_RANGE = (-18.83, 2.74)
TAU_SPLIT = -1.61
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
CRITICAL = {
    "crit_1pct": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5pct": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10pct": (-2.56677, -1.5384, -2.809, 0.0),
}


def decompose(
    panel: DataFrame, keys: tuple[str, ...] = (), period: int = 12, date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """Additive decomposition: centred moving-average trend, mean seasonal effect per phase, rest.

    The trend is null for half a period at both ends; a series shorter than two
    periods has no components. Everything runs in windows over the series keys,
    so there is one shuffle.
    """
    v = F.col(f"`{value_col}`")
    w = ordered(keys, date_col)
    whole = Window.partitionBy(*cols(keys))
    half = period // 2
    if period % 2:
        core, weight = F.sum(v).over(w.rowsBetween(-half, half)), F.lit(0.0)
        ends = F.lag(v, half).over(w) + F.lead(v, half).over(w)
    else:
        core = F.sum(v).over(w.rowsBetween(-(half - 1), half - 1))
        ends, weight = F.lag(v, half).over(w) + F.lead(v, half).over(w), F.lit(0.5)
    position = F.row_number().over(w)
    n = F.count(F.lit(1)).over(whole)
    staged = panel.withColumns({
        "trend": F.when((n >= 2 * period) & ends.isNotNull(), (core + weight * ends) / period),
        "_phase": (position - 1) % period,
    })
    by_phase = Window.partitionBy(*cols(keys), F.col("_phase"))
    staged = staged.withColumns({
        "_effect": F.avg(v - F.col("trend")).over(by_phase),
        "_copies": F.count(F.lit(1)).over(by_phase),
    })
    centre = F.sum(F.col("_effect") / F.col("_copies")).over(whole) / period
    return (
        staged.withColumn("seasonal", F.col("_effect") - centre)
        .withColumn("resid", v - F.col("trend") - F.col("seasonal"))
        .drop("_phase", "_effect", "_copies")
    )


def autocorrelation(
    panel: DataFrame, keys: tuple[str, ...] = (), max_lag: int = 15, date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """Autocorrelation at lags 0..max_lag as rows ``(keys..., lag, acf)``."""
    wide = _acf_arrays(panel, keys, max_lag, date_col, value_col)
    return wide.select(*cols(keys), F.posexplode("acf").alias("lag", "acf"))


def _acf_arrays(panel: DataFrame, keys: tuple[str, ...], max_lag: int, date_col: str, value_col: str) -> DataFrame:
    v = F.col(f"`{value_col}`")
    w = ordered(keys, date_col)
    centred = panel.withColumn("_c", v - F.avg(v).over(Window.partitionBy(*cols(keys))))
    products = centred.select(
        *cols(keys), *[(F.col("_c") * F.lag("_c", k).over(w)).alias(f"_p{k}") for k in range(max_lag + 1)]
    )
    sums = products.groupBy(*cols(keys)).agg(*[F.sum(f"_p{k}").alias(f"_s{k}") for k in range(max_lag + 1)])
    ratio = [F.when(F.col("_s0") > 0, F.col(f"_s{k}") / F.col("_s0")) for k in range(max_lag + 1)]
    return sums.select(*cols(keys), F.array(*ratio).alias("acf"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _durbin_levinson(acf: pd.Series) -> pd.Series:
    """Partial autocorrelations from autocorrelations, all series of the batch at once."""
    r = np.array([np.asarray(a, dtype=float) for a in acf])
    count, width = r.shape
    out = np.full((count, width), np.nan)
    out[:, 0] = 1.0
    phi = np.zeros((count, 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        for k in range(1, width):
            top = r[:, k] - np.sum(phi * r[:, k - 1:0:-1], axis=1)
            bottom = 1.0 - np.sum(phi * r[:, 1:k], axis=1)
            last = top / bottom
            phi = np.hstack([phi - last[:, None] * phi[:, ::-1], last[:, None]])
            out[:, k] = last
    return pd.Series([[None if np.isnan(x) else float(x) for x in row] for row in out])


def partial_autocorrelation(
    panel: DataFrame, keys: tuple[str, ...] = (), max_lag: int = 15, date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """Partial autocorrelation (Yule-Walker) at lags 0..max_lag as rows ``(keys..., lag, pacf)``."""
    wide = _acf_arrays(panel, keys, max_lag, date_col, value_col)
    return wide.select(*cols(keys), F.posexplode(_durbin_levinson("acf")).alias("lag", "pacf"))


def _adf_design(y: np.ndarray, lags: int) -> tuple[np.ndarray, np.ndarray]:
    """Regressors (level, lagged changes, constant) and the changes they explain."""
    change = np.diff(y)
    rows = len(change) - lags
    parts = [y[lags:lags + rows]] + [change[lags - j:lags - j + rows] for j in range(1, lags + 1)]
    return np.column_stack([*parts, np.ones(rows)]), change[lags:]


def _adf(y: np.ndarray) -> dict:
    """Dickey-Fuller regression with a constant, lag order by AIC on a common sample."""
    n = len(y)
    top = min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2)
    if top < 0 or np.ptp(y) == 0:
        return {"error": "too few or constant observations"}
    # the designs are nested, so one QR on the common sample gives the residuals of every lag order
    x, target = _adf_design(y, top)
    rows = len(target)
    q, _ = np.linalg.qr(x[:, [-1, *range(top + 1)]])
    left = float(target @ target) - np.cumsum((q.T @ target) ** 2)[1:]
    aic = rows * np.log(np.maximum(left, 1e-300) / rows) + 2 * (np.arange(top + 1) + 2)
    lags = int(np.argmin(aic))
    x, target = _adf_design(y, lags)
    rows = len(target)
    inverse = np.linalg.pinv(x.T @ x)
    beta = inverse @ (x.T @ target)
    ssr = float(np.sum((target - x @ beta) ** 2))
    if rows <= x.shape[1] or ssr <= 0:
        return {"error": "too few or constant observations"}
    stat = beta[0] / math.sqrt(ssr / (rows - x.shape[1]) * inverse[0, 0])
    if stat > TAU_RANGE[1]:
        p = 1.0
    elif stat < TAU_RANGE[0]:
        p = 0.0
    else:
        surface = SMALL_P if stat <= TAU_SPLIT else LARGE_P
        p = 0.5 * math.erfc(-sum(c * stat**i for i, c in enumerate(surface)) / math.sqrt(2.0))
    crit = {k: sum(c / rows**i for i, c in enumerate(v)) for k, v in CRITICAL.items()}
    return {"statistic": stat, "p_value": p, "used_lag": lags, "n_obs": rows, **crit, "error": None}


_ADF_FIELDS = ["statistic", "p_value", "used_lag", "n_obs", *CRITICAL, "error"]
_ADF_KINDS = {"used_lag": T.LongType(), "n_obs": T.LongType(), "error": T.StringType()}
_ADF_TYPE = T.StructType([T.StructField(f, _ADF_KINDS.get(f, T.DoubleType())) for f in _ADF_FIELDS])


@F.pandas_udf(_ADF_TYPE)
def _adf_batch(series: pd.Series) -> pd.DataFrame:
    found = [_adf(np.asarray(y, dtype=float)) for y in series]
    frame = pd.DataFrame({k: [r.get(k) for r in found] for k in _ADF_FIELDS})
    return frame.astype({"used_lag": "Int64", "n_obs": "Int64"})


def dickey_fuller(
    panel: DataFrame, keys: tuple[str, ...] = (), alpha: float = 0.05, date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """Augmented Dickey-Fuller test of each series, on its level and on its first difference.

    Two rows per series (``transform`` = level, difference) with the statistic,
    p-value, critical values and the verdict at ``alpha``. A series that cannot
    be tested keeps its row with the reason in ``error``.
    """
    change = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("y") - 1, F.lit(1))),
        lambda i: F.try_element_at("y", i + 1) - F.element_at("y", i),
    )
    variants = F.array(
        F.struct(F.lit("level").alias("transform"), F.col("y").alias("y")),
        F.struct(F.lit("difference").alias("transform"), F.filter(change, lambda x: x.isNotNull()).alias("y")),
    )
    return (
        pack(panel, keys, date_col, value_col)
        .select(*cols(keys), F.explode(variants).alias("t")).select(*cols(keys), "t.*")
        .withColumn("r", _adf_batch("y"))
        .select(*cols(keys), "transform", "r.*", (F.col("r.p_value") < alpha).alias("stationary"))
    )

