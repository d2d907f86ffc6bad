"""Fitted models as tables, the filter behind the seasonal ARIMA, simulated intervals, registered forecasters."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfseries.catalog import QUERIES
from shelfseries.errors import ModelTrainingError
from shelfseries.forecast import models, sarima, trend
from tests import golden

START = np.datetime64("2015-01-01", "D")


def panel_of(spark, series):
    rows = [(k, datetime.date(2015 + i // 12, i % 12 + 1, 1), None if v is None else float(v)) for k, ys in series.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "key string, Date date, Sales double")


def seasonal(rng, n, noise=5.0):
    t = np.arange(n)
    return 200 + 1.5 * t + 30 * np.sin(2 * np.pi * t / 12) + rng.normal(0, noise, n)


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(0)
    series = {f"s{k}": seasonal(rng, 48 + 12 * (k % 2)) for k in range(4)}
    return panel_of(spark, series | {"short": [1.0, 2.0, 3.0], "gap": [*range(40), None]})


def test_stored_models_forecast_like_a_fresh_fit(spark, panel, tmp_path):
    every = tuple(models.KERNELS)
    path = models.save_models(models.fit_models(panel, ("key",), every), str(tmp_path / "models"))
    stored = models.load_models(spark, path)
    assert stored.columns == ["key", "Model", "first", "last", "n", "parameters", "error"]
    for horizon in (1, 9):
        ahead = {(r.key, r.Model, r.step): r for r in models.predict(stored, ("key",), horizon).collect()}
        for m in every:
            for r in models.forecast(panel, ("key",), m, horizon).collect():
                a = ahead.pop((r.key, m, r.step))
                assert (a.error is None) == (r.error is None) and a.Date == r.Date
                if r.error is None:
                    assert (a.Forecast, a.Lower_CI, a.Upper_CI) == pytest.approx((r.Forecast, r.Lower_CI, r.Upper_CI), rel=1e-9)
        assert not ahead
    assert {r.key for r in stored.where("error is not null and Model = 'SARIMA'").collect()} == {"short", "gap"}
    with pytest.raises(FileNotFoundError):
        models.load_models(spark, str(tmp_path / "nothing"))
    with pytest.raises(ModelTrainingError):
        models.predict(stored, ("key",), 0)


def test_only_the_best_models_are_stored(spark, panel, tmp_path):
    best = models.best_models(models.comparison(models.evaluate(panel, ("key",)), ("key",)), ("key",))
    path = models.save_models(models.fit_models(panel, ("key",)), str(tmp_path / "best"), best, ("key",))
    kept = {(r.key, r.Model) for r in models.load_models(spark, path).collect()}
    assert kept == {(r.key, r.Model) for r in best.collect()}


def test_query_equals_the_best_forecast(spark, small):
    name = ["Region", "Model", "step"]
    one, two = ({tuple(r[c] for c in name): r for r in QUERIES[q](spark, small).collect()} for q in ("stored_model_forecast", "best_model_forecast"))
    assert one.keys() == two.keys() and one
    for k, r in one.items():
        assert (r.Forecast, r.Lower_CI, r.Upper_CI, r.Date) == (*map(pytest.approx, (two[k].Forecast, two[k].Lower_CI, two[k].Upper_CI)), two[k].Date)


def test_filter_equals_the_whole_covariance(monkeypatch):
    rng = np.random.default_rng(1)
    y = np.stack([1000 * seasonal(rng, 60) for _ in range(3)])
    p, s2 = np.array([[0.3, -0.5, 0.2, -0.4], [0.0, 0.0, 0.0, 0.0], [0.5, 0.2, -0.1, -0.6]]), np.full(3, 4e7)
    dense = sarima._loss(p, y, s2)
    monkeypatch.setattr(sarima, "DENSE", 0)
    assert sarima._loss(p, y, s2) == pytest.approx(dense, rel=1e-6)
    # the next months are the conditional means under the joint covariance
    c = sarima._covariance(p, s2, 64)
    weights = np.linalg.solve(c[:, :60, :60], c[:, 60:, :60].transpose(0, 2, 1)).transpose(0, 2, 1)
    want = np.einsum("bhn,bn->bh", weights, y)
    mean, spread, _ = sarima._filter(p, y, s2)
    fitted = np.column_stack([np.ones(3), s2, p, mean, spread.reshape(3, -1)])
    got, low, _ = sarima.sarima_predict(fitted, START, 60, 4)
    assert got == pytest.approx(want, rel=1e-5)
    deviation = np.sqrt(np.einsum("bhh->bh", c[:, 60:, 60:] - weights @ c[:, 60:, :60].transpose(0, 2, 1)))
    assert (got - low) / sarima.Z95 == pytest.approx(deviation, rel=1e-3)


def test_long_series_in_bounded_memory():
    import tracemalloc

    y = seasonal(np.random.default_rng(2), 5000, 20.0)[None]
    s2 = np.array([400.0])
    tracemalloc.start()
    value = sarima._loss(np.array([[0.1, -0.8, 0.0, -0.8]]), y, s2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(value).all() and peak < 20e6  # the whole covariance alone would be 200 MB


def test_filter_finds_published_forecast(monkeypatch):
    y = np.array(golden.MONTHLY)[None]
    dense = sarima.sarima_batch(y, START, 3)
    monkeypatch.setattr(sarima, "DENSE", 0)
    for a, b in zip(dense, sarima.sarima_batch(y, START, 3)):
        assert a == pytest.approx(b, rel=1e-4)


def test_interval_covers_simulated_futures():
    """About 80 % of the months that follow lie inside, for noise alone and for a trend that turns."""
    rng = np.random.default_rng(3)
    for turning in (False, True):
        y = []
        for _ in range(120):
            n = 72
            slope = 0.8 + (np.cumsum(rng.laplace(0, 0.4, n) * (rng.random(n) < 0.3)) if turning else 0)
            y.append(500 + np.cumsum(np.broadcast_to(slope, n)) + 20 * np.sin(2 * np.pi * np.arange(n) / 12) + rng.normal(0, 6, n))
        y = np.stack(y)
        _, low, high = trend.trend_batch(y[:, :66], START, 6)
        inside = ((y[:, 66:] >= low) & (y[:, 66:] <= high)).mean()
        assert 0.72 < inside < 0.88, turning
        width = high - low
        assert (width[:, -1] >= width[:, 0]).mean() > 0.6
    # a series has its bounds whatever batch it is in, and a longer horizon keeps the earlier steps
    alone = trend.trend_batch(y[5:6, :66], START, 9)
    assert alone[1][0, :6] == pytest.approx(low[5]) and alone[2][0, :6] == pytest.approx(high[5])


def test_joint_fit_of_a_seasonal_share(monkeypatch):
    rng = np.random.default_rng(4)
    t = np.arange(84)
    truth = np.stack([(100 + s * t) * (1 + 0.5 * np.sin(2 * np.pi * t / 12) + 0.2 * np.cos(4 * np.pi * t / 12)) for s in (2.0, 4.0, 8.0) * 6])
    y = truth[:, :72] + rng.normal(0, 8, (18, 72))
    joint = np.abs(trend.trend_ratio_batch(y, START, 12)[0] - truth[:, 72:]).mean()
    monkeypatch.setattr(trend, "JOINT_ROUNDS", 0)
    assert joint < np.abs(trend.trend_ratio_batch(y, START, 12)[0] - truth[:, 72:]).mean()


def test_registered_forecaster(spark, panel):
    def fit(y, start):
        return y[:, -12:]

    def same_month_last_year(fitted, start, n, horizon):
        mean = np.stack([fitted[:, h % 12] for h in range(horizon)], axis=1)
        return mean, mean - 1, mean + 1

    models.register("LastYear", fit, same_month_last_year)
    try:
        compared = models.comparison(models.evaluate(panel, ("key",), ("LastYear", "TrendSeasonal")), ("key",))
        assert {r.Model for r in compared.where("key = 's0'").collect()} == {"LastYear", "TrendSeasonal"}
        assert compared.where("Model = 'LastYear' and key = 's0'").first().RMSE < float("inf")
        fresh = models.forecast(panel, ("key",), "LastYear", 2).where("key = 's1'").orderBy("step").collect()
        stored = models.predict(models.fit_models(panel, ("key",), ("LastYear",)), ("key",), 2).where("key = 's1'").orderBy("step").collect()
        assert [r.Forecast for r in fresh] == [r.Forecast for r in stored]
        with pytest.raises(ModelTrainingError):
            models.register("LastYear", fit, same_month_last_year)
    finally:
        del models.KERNELS["LastYear"]
    with pytest.raises(ModelTrainingError):
        models.forecast(panel, ("key",), "LastYear")
