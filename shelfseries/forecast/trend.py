"""Piecewise-linear trend plus yearly Fourier seasonality, fitted by maximum a posteriori.

After Taylor and Letham, "Forecasting at scale" (2018): 25 possible slope changes
in the first 80 % of the history with a sparse (Laplace) prior, Fourier order 10
with a wide normal prior. The sparse prior is handled by reweighted ridge
regression. Series of one length and start share the design matrix.
"""

from __future__ import annotations

import numpy as np

MIN_POINTS = 3
CHANGEPOINTS = 25
CHANGEPOINT_SHARE = 0.8
FOURIER_ORDER = 10
YEAR_DAYS = 365.25
# prior scales of slope changes, seasonality, and of trend level and slope
SLOPE_CHANGE_SCALE, SEASON_SCALE, TREND_SCALE = 0.05, 10.0, 5.0
ROUNDS = 12
# steps of the joint fit of trend and seasonal share; simulated futures and their seed
JOINT_ROUNDS, PATHS, SEED = 6, 1000, 42


def _month_dates(start: np.datetime64, count: int) -> np.ndarray:
    first = start.astype("datetime64[M]")
    return (first + np.arange(count)).astype("datetime64[D]").astype(np.int64).astype(float)


def _design(days: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trend and seasonal columns for history and future, and scaled time (0..1 over the history)."""
    span = max(days[n - 1] - days[0], 1.0)
    t = (days - days[0]) / span
    knots = min(CHANGEPOINTS, max(int(np.floor(n * CHANGEPOINT_SHARE)) - 1, 0))
    spots = np.linspace(0, int(np.floor(n * CHANGEPOINT_SHARE)) - 1, knots + 1).round().astype(int)[1:]
    hinges = np.maximum(t[:, None] - t[spots][None, :], 0.0)
    angle = 2 * np.pi * days[:, None] * np.arange(1, FOURIER_ORDER + 1)[None, :] / YEAR_DAYS
    return np.column_stack([np.ones_like(t), t, hinges]), np.column_stack([np.sin(angle), np.cos(angle)]), t


def _posterior(x: np.ndarray, y: np.ndarray, scales: np.ndarray, sparse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (B, k) and noise deviation (B,) under normal priors, Laplace where ``sparse``.

    ``x`` is (n, k), shared by all series, or (B, n, k).
    """
    if x.ndim == 2:
        gram, moment = (x.T @ x)[None], y @ x
    else:
        gram, moment = np.einsum("bni,bnj->bij", x, x), np.einsum("bni,bn->bi", x, y)
    noise = np.maximum(0.5 * np.std(y, axis=1), 1e-4)
    variance = np.tile(scales**2, (len(y), 1))
    for _ in range(ROUNDS):
        lhs = gram / noise[:, None, None] ** 2 + np.eye(x.shape[-1]) / variance[:, None, :]
        beta = np.linalg.solve(lhs, (moment / noise[:, None] ** 2)[:, :, None])[:, :, 0]
        # degrees of freedom keep the noise from collapsing when columns outnumber rows
        used = np.einsum("bij,bji->b", np.linalg.inv(lhs), np.broadcast_to(gram, lhs.shape)) / noise**2
        rest = np.sum((y - (beta @ x.T if x.ndim == 2 else np.einsum("bni,bi->bn", x, beta))) ** 2, axis=1)
        noise = np.sqrt(np.maximum(rest / np.maximum(y.shape[1] - used, 1.0), 1e-8))
        variance[:, sparse] = np.maximum(np.abs(beta[:, sparse]) * scales[sparse], 1e-6)
    return beta, noise


def _fit(y: np.ndarray, start: np.datetime64, multiplicative: bool) -> np.ndarray:
    """(B, 2 + k) fitted models: scale of the series, noise, coefficients of trend and season."""
    n = y.shape[1]
    if n < MIN_POINTS:
        raise ValueError(f"needs at least {MIN_POINTS} months, has {n}")
    size = np.maximum(np.abs(y).max(axis=1), 1e-9)
    scaled = y / size[:, None]
    trend, season, _ = _design(_month_dates(start, n), n)
    x, (scales, sparse), k = np.column_stack([trend, season]), _scales(trend, season), trend.shape[1]
    if not multiplicative:
        beta, noise = _posterior(x, scaled, scales, sparse)
        return np.column_stack([size, noise, beta])
    # trend times (1 + season): first the trend and its ratio, then both at once around the last estimate
    beta, _ = _posterior(trend, scaled, scales[:k], sparse[:k])
    level = beta @ trend.T
    gamma, noise = _posterior(season, scaled / _away(level) - 1.0, scales[k:], sparse[k:])
    for _ in range(JOINT_ROUNDS):
        level, share = beta @ trend.T, gamma @ season.T
        # the product's tangent: columns of the trend times (1 + share), columns of the season times the level
        slope = np.concatenate([trend[None] * (1.0 + share)[:, :, None], season[None] * level[:, :, None]], axis=2)
        both, noise = _posterior(slope, scaled + level * share, scales, sparse)
        beta, gamma = both[:, :k], both[:, k:]
    return np.column_stack([size, noise, beta, gamma])


def _away(level: np.ndarray) -> np.ndarray:
    return np.maximum(np.abs(level), 1e-6) * np.where(level < 0, -1, 1)


def _paths(ahead: np.ndarray, knots: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeded futures for a series of unit scales: (paths, horizon) trend departures and noise.

    Slope changes arrive by a Poisson process at the rate of the history's, Laplace in size; a step's draws depend on the step
    alone, so neither the batch nor the horizon changes them.
    """
    slope, level, before = np.zeros(PATHS), np.zeros(PATHS), 0.0
    drift, noise = [], []
    for step, now in enumerate(ahead):
        rng = np.random.default_rng([SEED, step])
        noise.append(rng.standard_normal(PATHS))
        width = now - before
        times = rng.poisson(knots * width, PATHS)
        # the sum of a few Laplace sizes, each at the middle of its step
        change = np.where(times > 0, rng.laplace(size=PATHS) * np.sqrt(np.maximum(times, 1)), 0.0)
        level = level + slope * width + change * width / 2
        slope, before = slope + change, now
        drift.append(level)
    return np.column_stack(drift), np.column_stack(noise)


def _scales(trend: np.ndarray, season: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prior scales of the columns, and which of them have a sparse prior."""
    k, m = trend.shape[1], season.shape[1]
    scales = np.concatenate([[TREND_SCALE, TREND_SCALE], np.full(k - 2, SLOPE_CHANGE_SCALE), np.full(m, SEASON_SCALE)])
    return scales, (np.arange(k + m) >= 2) & (np.arange(k + m) < k)


def _unsure(past: np.ndarray, future: np.ndarray, fitted: np.ndarray, scales: np.ndarray, sparse: np.ndarray) -> np.ndarray:
    """(B, horizon) posterior variance of the mean: coefficients are estimates too."""
    sigma, beta = fitted[:, 1], fitted[:, 2:]
    variance = np.where(sparse, np.maximum(np.abs(beta) * scales, 1e-6), scales**2)
    gram = np.einsum("bni,bnj->bij", past, past) if past.ndim == 3 else (past.T @ past)[None]
    lhs = gram / sigma[:, None, None] ** 2 + np.eye(beta.shape[1]) / variance[:, None, :]
    rows = np.broadcast_to(future, (len(beta), *future.shape[-2:]))
    return np.maximum(np.einsum("bhi,bih->bh", rows, np.linalg.solve(lhs, rows.transpose(0, 2, 1))), 0.0)


def _predict(fitted: np.ndarray, start: np.datetime64, n: int, horizon: int, multiplicative: bool):
    """Mean and 80 % bounds, clamped at 0: quantiles of simulated futures, in which the slope changes, months are noisy and
    the mean is as unsure as its coefficients."""
    size, sigma = fitted[:, 0], fitted[:, 1]
    trend, season, t = _design(_month_dates(start, n + horizon), n)
    knots = trend.shape[1] - 2
    beta, gamma = fitted[:, 2:2 + trend.shape[1]], fitted[:, 2 + trend.shape[1]:]
    level, share = beta @ trend[n:].T, gamma @ season[n:].T
    mean = level * (1.0 + share) if multiplicative else level + share
    # future slope changes have the historical mean size
    jump = np.abs(beta[:, 2:]).mean(axis=1) if knots else np.zeros(len(fitted))
    drift, noise = _paths(t[n:] - t[n - 1], knots)
    lower, upper = np.empty_like(mean), np.empty_like(mean)
    x = np.column_stack([trend, season])
    if multiplicative:
        x = np.concatenate([trend[None] * (1.0 + gamma @ season.T)[:, :, None], season[None] * (beta @ trend.T)[:, :, None]], axis=2)
    spread = np.sqrt(sigma[:, None] ** 2 + _unsure(x[..., :n, :], x[..., n:, :], fitted, *_scales(trend, season)))
    for i in range(len(fitted)):
        moved = jump[i] * drift * ((1.0 + share[i]) if multiplicative else 1.0)
        lower[i], upper[i] = np.quantile(mean[i] + moved + spread[i] * noise, [0.1, 0.9], axis=0)
    return tuple(np.maximum(b * size[:, None], 0.0) for b in (mean, np.minimum(lower, mean), np.maximum(upper, mean)))


def trend_fit(y: np.ndarray, start: np.datetime64) -> np.ndarray:
    return _fit(y, start, False)


def trend_predict(fitted: np.ndarray, start: np.datetime64, n: int, horizon: int):
    return _predict(fitted, start, n, horizon, False)


def trend_ratio_fit(y: np.ndarray, start: np.datetime64) -> np.ndarray:
    return _fit(y, start, True)


def trend_ratio_predict(fitted: np.ndarray, start: np.datetime64, n: int, horizon: int):
    return _predict(fitted, start, n, horizon, True)


def trend_batch(y: np.ndarray, start: np.datetime64, horizon: int):
    """Mean and 80 % bounds, clamped at 0, with additive seasonality."""
    return trend_predict(trend_fit(y, start), start, y.shape[1], horizon)


def trend_ratio_batch(y: np.ndarray, start: np.datetime64, horizon: int):
    """The same with seasonality as a share of the trend, both fitted together."""
    return trend_ratio_predict(trend_ratio_fit(y, start), start, y.shape[1], horizon)
