import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfseries.errors import ModelTrainingError
from shelfseries.forecast import boosted, models
from shelfseries.forecast.trend import trend_batch
from tests import golden

SCHEMA = "key string, Date date, Sales double"


def panel(spark, **series):
    rows = [(k, d, float(v)) for k, values in series.items() for d, v in zip(golden.months((2015, 1), len(values)), values)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def evaluated(spark):
    return models.evaluate(panel(spark, shop=golden.MONTHLY, short=[1, 2, 3, 4, 5], brief=range(1, 11)), ("key",)).persist()


@pytest.fixture(scope="module")
def compared(evaluated):
    return models.comparison(evaluated, ("key",)).toPandas().set_index(["key", "Model"])


def test_published_sarima_result(spark, compared):
    row = compared.loc[("shop", "SARIMA")]
    assert tuple(row[["MAE", "RMSE", "MAPE"]]) == pytest.approx(golden.SARIMA_HOLDOUT, rel=1e-5)
    assert [row[f"Forecast Month {i}"] for i in (1, 2, 3)] == pytest.approx(golden.SARIMA_MONTHS, rel=2e-5)
    out = models.forecast(panel(spark, shop=golden.MONTHLY), ("key",), "SARIMA").orderBy("step").toPandas()
    assert list(out.Lower_CI) == pytest.approx(golden.SARIMA_LOWER, rel=5e-5)
    assert list(out.Upper_CI) == pytest.approx(golden.SARIMA_UPPER, rel=5e-5)
    assert [str(d) for d in out.Date] == ["2019-01-01", "2019-02-01", "2019-03-01"]


def test_published_boosted_result(compared):
    row = compared.loc[("shop", "BoostedTrees")]
    assert tuple(row[["MAE", "RMSE", "MAPE"]]) == pytest.approx(golden.BOOSTED_HOLDOUT, rel=1e-5)
    assert [row[f"Forecast Month {i}"] for i in (1, 2, 3)] == pytest.approx(golden.BOOSTED_MONTHS, rel=1e-5)


def test_trend_model_beats_seasonal_naive(compared):
    actual, naive = np.array(golden.MONTHLY[-3:]), np.array(golden.MONTHLY[-15:-12])
    row = compared.loc[("shop", "TrendSeasonal")]
    assert row.MAE < np.abs(actual - naive).mean()
    assert row.RMSE < np.sqrt(((actual - naive) ** 2).mean())
    assert row.MAPE < (np.abs(actual - naive) / actual).mean()


def test_failures_become_rows(compared):
    short = compared.loc["short"]
    assert np.isinf(short.RMSE).all() and short.error.str.contains("not enough periods").all()
    assert np.isinf(compared.loc[("brief", "SARIMA")].RMSE)
    assert "at least 30 months" in compared.loc[("brief", "SARIMA")].error
    assert np.isfinite(compared.loc[("brief", "TrendSeasonal")].RMSE)


def test_best_model_is_lowest_rmse_among_full_fits(evaluated, compared):
    best = {r["key"]: r.Model for r in models.best_models(models.comparison(evaluated, ("key",)), ("key",)).collect()}
    assert set(best) == {"shop", "brief"}
    assert best["shop"] == compared.loc["shop"].RMSE.idxmin()


def test_bounds_are_ordered_and_non_negative(evaluated):
    out = evaluated.where("Forecast is not null").toPandas()
    assert (out.Forecast >= 0).all() and (out.Lower_CI >= 0).all()
    assert (out.Lower_CI <= out.Forecast + 1e-9).all() and (out.Forecast <= out.Upper_CI + 1e-9).all()


def test_longer_horizon_keeps_earlier_steps(spark):
    df = panel(spark, shop=golden.MONTHLY)
    for model in models.KERNELS:
        three = [r.Forecast for r in models.forecast(df, ("key",), model, 3).orderBy("step").collect()]
        six = [r.Forecast for r in models.forecast(df, ("key",), model, 6).orderBy("step").collect()]
        assert six[:3] == pytest.approx(three, rel=1e-6)


def test_save_and_load_best(spark, evaluated, tmp_path):
    best = models.best_models(models.comparison(evaluated, ("key",)), ("key",))
    path = models.save_best(models.best_forecast(evaluated, best, ("key",), models.MAX_HORIZON), str(tmp_path / "best"))
    assert models.load_best(spark, path, 4).groupBy("key").count().select("count").distinct().collect()[0][0] == 4
    with pytest.raises(FileNotFoundError):
        models.load_best(spark, str(tmp_path / "none"))
    with pytest.raises(ModelTrainingError):
        models.load_best(spark, path, 7)


def test_arguments_are_checked(spark):
    with pytest.raises(ModelTrainingError, match="unknown model"):
        models.forecast(panel(spark, a=[1, 2]), ("key",), "Magic")
    with pytest.raises(ModelTrainingError):
        models.forecast(panel(spark, a=[1, 2]), ("key",), "SARIMA", 0)


def test_trend_model_recovers_a_known_signal():
    t = np.arange(96)
    season = 20 * np.sin(2 * np.pi * t / 12) + 10 * np.cos(4 * np.pi * t / 12)
    signal = 200 + 1.5 * t + season
    noisy = signal[:84] + np.random.default_rng(1).normal(0, 2, 84)
    mean, lower, upper = trend_batch(noisy[None, :], np.datetime64("2010-01-01"), 12)
    assert np.abs(mean[0] - signal[84:]).max() < 10
    assert ((lower[0] < signal[84:]) & (signal[84:] < upper[0])).mean() >= 0.7


def test_sarima_recovers_a_simulated_process():
    rng = np.random.default_rng(5)
    shocks = rng.normal(0, 100, 200)
    w = np.zeros(200)
    for i in range(13, 200):
        w[i] = 0.5 * w[i - 1] + shocks[i] - 0.4 * shocks[i - 12]
    level = np.zeros(200)
    for i in range(13, 200):
        level[i] = level[i - 1] + level[i - 12] - level[i - 13] + w[i]
    y = (level[80:] - level.min() + 5000)[None, :]
    from shelfseries.forecast.sarima import sarima_batch

    held = sarima_batch(y[:, :-3], np.datetime64("2010-01-01"), 3)
    assert (held[1][0] <= y[0, -3:]).all() and (y[0, -3:] <= held[2][0]).all()


def test_boosted_trees_against_plain_recursion():
    """The batched trees equal a plain recursive tree builder on the same rows."""
    y = np.array(golden.MONTHLY)[None, :]
    month = np.arange(48) % 12 + 1
    x, target = boosted._features(y, month)[0], y[0, boosted.LAGS:]

    def build(rows, gradient, depth):
        g = gradient[rows].sum()
        best = (1e-6, None, None)
        if depth < boosted.DEPTH:
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[1:]:
                    left = rows[x[rows, f] < cut]
                    gl = gradient[left].sum()
                    hl, hr = len(left), len(rows) - len(left)
                    gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (hr + 1) - g**2 / (len(rows) + 1)
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, f, cut)
        out = np.zeros(len(x))
        if best[1] is None:
            out[rows] = -g / (len(rows) + 1) * boosted.RATE
            return out
        goes_left = x[rows, best[1]] < best[2]
        return build(rows[goes_left], gradient, depth + 1) + build(rows[~goes_left], gradient, depth + 1)

    fitted = np.full(len(target), target.mean())
    rank, edge = boosted._bins(x[None])
    batched = fitted[None].copy()
    for _ in range(10):
        fitted = fitted + build(np.arange(len(target)), fitted - target, 0)
        tree = boosted._grow(rank, edge, batched - target[None])
        batched = batched + np.take_along_axis(tree[2], tree[3], axis=1)
        assert batched[0] == pytest.approx(fitted)


def test_pooled_boosting(spark):
    df = panel(spark, shop=golden.MONTHLY, double=[2 * v for v in golden.MONTHLY])
    out = boosted.pooled_boosting(df, ("key",), horizon=2, trees=10).toPandas()
    assert len(out) == 4
    assert ((out.Lower_CI >= 0) & (out.Lower_CI <= out.Forecast) & (out.Forecast <= out.Upper_CI)).all()
    by = out.set_index(["key", "step"]).Forecast
    assert by["double", 1] / by["shop", 1] == pytest.approx(2, rel=0.5)
    assert boosted.pooled_boosting(df.where("key = 'shop'").drop("key"), (), 1, trees=5).count() == 1


def test_pooled_boosting_reads_the_panel_once(spark):
    """Training, residuals and all steps share one evaluation of what the panel comes from."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = panel(spark, shop=golden.MONTHLY, double=[2 * v for v in golden.MONTHLY])
    rows = df.count()
    out = boosted.pooled_boosting(df.mapInPandas(counted, df.schema), ("key",), horizon=3, trees=2)
    assert out.count() == 6 and seen.value == rows


def test_history_and_forecast_axis(spark):
    df = panel(spark, shop=golden.MONTHLY)
    out = models.history_and_forecast(df, models.forecast(df, ("key",), "TrendSeasonal"), ("key",))
    assert {r.kind: r["count"] for r in out.groupBy("kind").count().collect()} == {"history": 48, "forecast": 3}
    shown = models.display_forecast(models.forecast(df, ("key",), "TrendSeasonal"), ("key",)).orderBy("Date")
    assert "2019-Jan" in [r.Date for r in shown.collect()]
    assert out.where(F.col("kind") == "history").where("Lower_CI is not null").count() == 0
