"""Seasonal ARIMA (1,1,1)(1,1,1)12 for batches of monthly series.

A series with a vague prior on its pre-sample state is jointly normal with
covariance ``C = 1e6 V V' + s2 P P'``: V holds the loadings of the 27 initial
states, P the response to past shocks. For up to ``DENSE`` months the Cholesky factor
of C gives all one-step errors at once, so many series of one length are handled by a
few stacked matrix operations; longer series go through a Kalman filter, whose work
grows with the length and whose memory does not. The filter's last state is all that
a forecast needs, so it is what a fitted model keeps. The likelihood leaves out the
first 27 errors, which the prior dominates; coefficients are unconstrained; the shock
variance stays at its regression estimate.
"""

from __future__ import annotations

import numpy as np

SEASON = 12
STATES = 27
PRIOR_VARIANCE = 1e6
MIN_POINTS = STATES + 3
Z95 = 1.959963984540054
STEPS = 60
CHUNK = 64
LIMIT = 3.0
#: Months up to which the likelihood is worked out from the whole covariance matrix.
DENSE = 256
#: The state's covariance counts as settled when a year changes it by no more than this share.
SETTLED = 1e-11


def _loadings(p: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """V (B, n, 27) and the shock responses (B, n) under coefficients (B, 4).

    States: the last level, twelve past changes, fourteen ARMA states.
    """
    ar1, ma1, ar2, ma2 = p.T
    ar = np.zeros((len(p), 14))
    ma = np.zeros((len(p), 14))
    ar[:, 0], ar[:, 11], ar[:, 12] = ar1, ar2, -ar1 * ar2
    ma[:, 0], ma[:, 1], ma[:, 12], ma[:, 13] = 1.0, ma1, ma2, ma1 * ma2
    rows = np.zeros((len(p), n, STATES))
    rows[:, 0, [0, 12, 13]] = 1.0
    for t in range(1, n):
        last, new = rows[:, t - 1], rows[:, t]
        total = last[:, 0] + last[:, 1]
        new[:, 0] = last[:, 0]
        new[:, 1:12] = last[:, 2:13]
        new[:, 12] = total
        new[:, 13] = total + np.sum(last[:, 13:] * ar, axis=1)
        new[:, 14:] = last[:, 13:26]
    return rows, np.einsum("bts,bs->bt", rows[:, :, 13:], ma)


def _covariance(p: np.ndarray, s2: np.ndarray, n: int) -> np.ndarray:
    rows, response = _loadings(p, n)
    gap = np.arange(n)[:, None] - np.arange(n)[None, :] - 1
    shocks = np.where(gap >= 0, response[:, np.maximum(gap, 0)], 0.0)
    return PRIOR_VARIANCE * rows @ rows.transpose(0, 2, 1) + s2[:, None, None] * shocks @ shocks.transpose(0, 2, 1)


def _factor(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cholesky factors of a stack and which of them exist; one by one only if the stack fails."""
    valid = np.isfinite(c).all(axis=(1, 2))
    lower = np.tile(np.eye(c.shape[1]), (len(c), 1, 1))
    try:
        lower[valid] = np.linalg.cholesky(c[valid])
    except np.linalg.LinAlgError:
        for i in np.flatnonzero(valid):
            try:
                lower[i] = np.linalg.cholesky(c[i])
            except np.linalg.LinAlgError:
                valid[i] = False
    return lower, valid


def _ahead(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The transition of the state, applied to the second axis of (B, 27, ...).

    States: the last level, twelve past changes, fourteen ARMA states. A month's
    change is the one twelve months before plus the first ARMA state.
    """
    shape = (len(p),) + (1,) * (x.ndim - 2)
    ar1, _, ar2, _ = (c.reshape(shape) for c in p.T)
    out = np.empty_like(x)
    out[:, 1] = x[:, 12] + x[:, 13]
    out[:, 0] = x[:, 0] + out[:, 1]
    out[:, 2:13] = x[:, 1:12]
    out[:, 13:26] = x[:, 14:27]
    out[:, 26] = 0.0
    out[:, 13] += ar1 * x[:, 13]
    out[:, 24] += ar2 * x[:, 13]
    out[:, 25] -= ar1 * ar2 * x[:, 13]
    return out


def _seen(x: np.ndarray) -> np.ndarray:
    """What the state shows of itself: the sum of three of its entries."""
    return x[:, 0] + x[:, 12] + x[:, 13]


def _shock(p: np.ndarray) -> np.ndarray:
    """How a shock enters the (B, 27) state."""
    _, ma1, _, ma2 = p.T
    out = np.zeros((len(p), STATES))
    out[:, 13], out[:, 14], out[:, 25], out[:, 26] = 1.0, ma1, ma2, ma1 * ma2
    return out


def _filter(p: np.ndarray, y: np.ndarray, s2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next state's mean (B, 27) and covariance after all of ``y``, and the summed negative log likelihood.

    The covariance does not depend on the data: once it has settled, only means are carried on.
    """
    count, n = y.shape
    mean = np.zeros((count, STATES))
    spread = np.tile(PRIOR_VARIANCE * np.eye(STATES), (count, 1, 1))
    enter = _shock(p)
    noise = s2[:, None, None] * enter[:, :, None] * enter[:, None, :]
    total, settled, last = np.zeros(count), False, spread
    with np.errstate(all="ignore"):
        for t in range(n):
            if not settled:
                shown = _seen(spread)
                variance = _seen(shown)
                gain = _ahead(shown, p) / variance[:, None]
            error = y[:, t] - _seen(mean)
            mean = _ahead(mean, p) + gain * error[:, None]
            if t >= STATES:
                total += 0.5 * (error**2 / variance + np.log(variance))
            if not settled:
                moved = _ahead(_ahead(spread, p).transpose(0, 2, 1), p)
                spread = moved - gain[:, :, None] * gain[:, None, :] * variance[:, None, None] + noise
                spread = (spread + spread.transpose(0, 2, 1)) / 2
                if t >= 4 * SEASON and t % SEASON == 0:
                    settled = bool(np.nanmax(np.abs(spread - last)) <= SETTLED * np.nanmax(np.abs(spread)))
                    last = spread
    return mean, spread, total


def _loss(p: np.ndarray, y: np.ndarray, s2: np.ndarray) -> np.ndarray:
    """Negative log likelihood per observation (up to a constant), infinite where there is none."""
    sane = np.abs(p).max(axis=1) < LIMIT
    if y.shape[1] > DENSE:
        out = _filter(np.where(sane[:, None], p, 0.0), y, s2)[2] / y.shape[1]
        return np.where(sane & np.isfinite(out), out, np.inf)
    lower, valid = _factor(_covariance(np.where(sane[:, None], p, 0.0), s2, y.shape[1]))
    errors = np.linalg.solve(lower, y[:, :, None])[:, STATES:, 0]
    logs = np.log(np.einsum("bii->bi", lower))[:, STATES:]
    out = np.sum(0.5 * errors**2 + logs, axis=1) / y.shape[1]
    return np.where(sane & valid & np.isfinite(out), out, np.inf)


def _gradient(p: np.ndarray, y: np.ndarray, s2: np.ndarray) -> np.ndarray:
    width = 1e-5 * np.maximum(1.0, np.abs(p))
    out = np.zeros_like(p)
    for i in range(p.shape[1]):
        move = np.zeros_like(p)
        move[:, i] = width[:, i]
        above, below = _loss(p + move, y, s2), _loss(p - move, y, s2)
        known = np.isfinite(above) & np.isfinite(below)
        out[known, i] = (above[known] - below[known]) / (2 * width[known, i])
    return out


def _shift(x: np.ndarray, lag: int) -> np.ndarray:
    return np.concatenate([np.zeros((len(x), lag)), x[:, :-lag]], axis=1)


def _regress(columns: list[np.ndarray], target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.stack(columns, axis=2)
    beta = np.einsum("bkm,bm->bk", np.linalg.pinv(x), target)
    return beta, target - np.einsum("bmk,bk->bm", x, beta)


def _start(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two-step regression on the differenced series: (1,1) coefficients and shock variance."""
    _, rest = _regress([_shift(w, 1)[:, 2:], _shift(w, 2)[:, 2:]], w[:, 2:])
    beta, left = _regress([_shift(w, 1)[:, 3:], _shift(rest, 1)[:, 1:]], w[:, 3:])
    zero = np.zeros(len(w))
    variance = np.mean(left[:, 1:] ** 2, axis=1)
    return np.column_stack([beta[:, 0], beta[:, 1], zero, zero]), variance


def _maximise(y: np.ndarray, p: np.ndarray, s2: np.ndarray) -> np.ndarray:
    """Quasi-Newton (BFGS) steps with backtracking, every series at its own pace."""
    count, size = p.shape
    inverse = np.tile(np.eye(size), (count, 1, 1))
    value, slope = _loss(p, y, s2), _gradient(p, y, s2)
    active = np.isfinite(value)
    for _ in range(STEPS):
        step = -np.einsum("bij,bj->bi", inverse, slope)
        uphill = np.sum(step * slope, axis=1) > 0
        inverse[uphill], step[uphill] = np.eye(size), -slope[uphill]
        descent = np.sum(step * slope, axis=1)
        length = np.where(active, 1.0, 0.0)
        open_ = active.copy()
        trial, trial_value = p.copy(), value.copy()
        for _ in range(30):
            if not open_.any():
                break
            where = np.flatnonzero(open_)
            candidate = p[where] + length[where, None] * step[where]
            found = _loss(candidate, y[where], s2[where])
            good = found < value[where] + 1e-4 * length[where] * descent[where]
            hit = where[good]
            trial[hit], trial_value[hit] = candidate[good], found[good]
            open_[hit] = False
            length[where[~good]] /= 2
        active &= ~open_
        if not active.any():
            break
        where = np.flatnonzero(active)
        fresh = _gradient(trial[where], y[where], s2[where])
        dp, dg = trial[where] - p[where], fresh - slope[where]
        curve = np.sum(dp * dg, axis=1)
        update = curve > 1e-14
        rho = 1.0 / np.where(update, curve, 1.0)
        left = np.eye(size) - rho[:, None, None] * dp[:, :, None] * dg[:, None, :]
        revised = left @ inverse[where] @ left.transpose(0, 2, 1) + rho[:, None, None] * dp[:, :, None] * dp[:, None, :]
        inverse[where] = np.where(update[:, None, None], revised, inverse[where])
        p[where], value[where], slope[where] = trial[where], trial_value[where], fresh
        active[where] &= np.abs(fresh).max(axis=1) > 1e-6
    return p


def _fit(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients (NaN without a likelihood), shock variance, and the state after the last month."""
    w = np.diff(y, axis=1)
    w = w[:, SEASON:] - w[:, :-SEASON]
    start, s2 = _start(w)
    s2 = np.maximum(s2, 1e-6)
    p = _maximise(y, start, s2)
    usable = np.isfinite(_loss(p, y, s2))
    mean, spread, _ = _filter(np.where(usable[:, None], p, 0.0), y, s2)
    return np.where(usable[:, None], p, np.nan), s2, mean, spread


def sarima_fit(y: np.ndarray, start: np.datetime64) -> np.ndarray:
    """(B, 763) fitted models of (B, n) series: scale, shock variance, coefficients, last state and its covariance."""
    if y.shape[1] < MIN_POINTS:
        raise ValueError(f"needs at least {MIN_POINTS} months, has {y.shape[1]}")
    # the prior must be wide against the data, so small-valued series are enlarged
    unit = np.maximum(1.0, 1e3 / np.maximum(np.std(y, axis=1), 1e-9))
    parts = []
    for i in range(0, len(y), CHUNK):
        p, s2, mean, spread = _fit(y[i:i + CHUNK] * unit[i:i + CHUNK, None])
        parts.append(np.column_stack([unit[i:i + CHUNK], s2, p, mean, spread.reshape(len(p), -1)]))
    return np.concatenate(parts)


def sarima_predict(fitted: np.ndarray, start: np.datetime64, n: int, horizon: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean (NaN without a likelihood) and 95 % bounds, clamped at 0, of the next ``horizon`` months."""
    unit, s2, p = fitted[:, 0], fitted[:, 1], fitted[:, 2:6]
    usable = np.isfinite(p).all(axis=1)
    p = np.where(usable[:, None], p, 0.0)
    mean, spread = fitted[:, 6:6 + STATES], fitted[:, 6 + STATES:].reshape(-1, STATES, STATES)
    enter = _shock(p)
    noise = s2[:, None, None] * enter[:, :, None] * enter[:, None, :]
    steps, variances = [], []
    for _ in range(horizon):
        steps.append(_seen(mean))
        variances.append(_seen(_seen(spread)))
        mean, spread = _ahead(mean, p), _ahead(_ahead(spread, p).transpose(0, 2, 1), p) + noise
    middle = np.where(usable[:, None], np.column_stack(steps), np.nan) / unit[:, None]
    width = Z95 * np.sqrt(np.maximum(np.column_stack(variances), 0.0)) / unit[:, None]
    return np.maximum(middle, 0.0), np.maximum(middle - width, 0.0), np.maximum(middle + width, 0.0)


def sarima_batch(y: np.ndarray, start: np.datetime64, horizon: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fit and forecast of (B, n) series at once."""
    return sarima_predict(sarima_fit(y, start), start, y.shape[1], horizon)
