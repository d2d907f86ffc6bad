"""The models by name, run over packed series, compared on a holdout, stored and read back."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ModelTrainingError
from ..functions import calendar as cal
from ..operators.packing import pack
from ..operators.windows import cols
from .boosted import boosted_fit, boosted_predict
from .sarima import sarima_fit, sarima_predict
from .trend import trend_fit, trend_predict, trend_ratio_fit, trend_ratio_predict


class Kernel(NamedTuple):
    """``fit((B, n) values, first month)`` gives (B, m) numbers, a row per series that says all about its model, NaN where
    there is none; ``predict(these, first month, n, horizon)`` gives mean and bounds, each (B, horizon)."""

    fit: Callable
    predict: Callable


KERNELS: dict[str, Kernel] = {
    "SARIMA": Kernel(sarima_fit, sarima_predict),
    "TrendSeasonal": Kernel(trend_fit, trend_predict),
    "TrendSeasonalRatio": Kernel(trend_ratio_fit, trend_ratio_predict),
    "BoostedTrees": Kernel(boosted_fit, boosted_predict),
}


def register(name: str, fit: Callable, predict: Callable) -> None:
    """Add a forecaster under a name of its own; its functions travel with the jobs that ask for it."""
    if name in KERNELS:
        raise ModelTrainingError(f"there is a model {name} already")
    KERNELS[name] = Kernel(fit, predict)


COMPARED = ("SARIMA", "TrendSeasonal", "BoostedTrees")
MAX_HORIZON = 6

_RESULT = T.StructType([
    *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("mean", "lower", "upper")],
    T.StructField("error", T.StringType()),
])


_FITTED = T.StructType([T.StructField("parameters", T.ArrayType(T.DoubleType())), T.StructField("error", T.StringType())])


def _alike(*columns: pd.Series) -> dict[tuple, list[int]]:
    """Rows that agree in all columns, which a kernel handles together."""
    groups: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(*columns)):
        groups.setdefault(key, []).append(i)
    return groups


def _fit_rows(kernel: Kernel, series: list, first) -> tuple[list[int], np.ndarray, dict[int, str]]:
    """Positions of the series that were fitted, their models, and the errors of the others."""
    values = np.array([np.asarray(y, dtype=float) for y in series])
    usable = np.isfinite(values).all(axis=1)
    errors = {i: "the series has missing or infinite values" for i in np.flatnonzero(~usable).tolist()}
    some = np.flatnonzero(usable).tolist()
    if not some:
        return [], np.empty((0, 0)), errors
    try:
        return some, kernel.fit(values[usable], np.datetime64(first, "D")), errors
    except (ValueError, np.linalg.LinAlgError) as error:
        return [], np.empty((0, 0)), errors | dict.fromkeys(some, str(error))


def _outcome(mean: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> tuple:
    if np.isfinite(mean).all():
        return mean.tolist(), lower.tolist(), upper.tolist(), None
    return None, None, None, "the fit did not converge"


def _runner(kernels: dict[str, Kernel]):
    @F.pandas_udf(_RESULT)
    def run(model: pd.Series, y: pd.Series, start: pd.Series, horizon: pd.Series) -> pd.DataFrame:
        """Forecast every row; rows of one model, length, start and horizon go through its kernel together."""
        out: list[tuple] = [(None, None, None, "unknown model")] * len(model)
        for (name, n, first, steps), rows in _alike(model, y.map(len), start, horizon).items():
            if name in kernels:
                some, fitted, errors = _fit_rows(kernels[name], [y.iloc[i] for i in rows], first)
                for k, message in errors.items():
                    out[rows[k]] = (None, None, None, message)
                if some:
                    parts = kernels[name].predict(fitted, np.datetime64(first, "D"), n, int(steps))
                    for k, part in zip(some, zip(*parts)):
                        out[rows[k]] = _outcome(*part)
        return pd.DataFrame(out, columns=["mean", "lower", "upper", "error"])
    return run


def _fitter(kernels: dict[str, Kernel]):
    @F.pandas_udf(_FITTED)
    def run(model: pd.Series, y: pd.Series, start: pd.Series) -> pd.DataFrame:
        """The fitted model of every row as numbers."""
        out: list[tuple] = [(None, "unknown model")] * len(model)
        for (name, _, first), rows in _alike(model, y.map(len), start).items():
            if name in kernels:
                some, fitted, errors = _fit_rows(kernels[name], [y.iloc[i] for i in rows], first)
                for k, message in errors.items():
                    out[rows[k]] = (None, message)
                for k, one in zip(some, fitted):
                    out[rows[k]] = (one.tolist(), None)
        return pd.DataFrame(out, columns=["parameters", "error"])
    return run


def _predictor(kernels: dict[str, Kernel]):
    @F.pandas_udf(_RESULT)
    def run(model: pd.Series, parameters: pd.Series, start: pd.Series, n: pd.Series, horizon: pd.Series) -> pd.DataFrame:
        """Forecasts from fitted models, without a fit."""
        out: list[tuple] = [(None, None, None, "unknown model")] * len(model)
        size = parameters.map(lambda x: -1 if x is None else len(x))
        for (name, first, length, steps, width), rows in _alike(model, start, n, horizon, size).items():
            if width < 0:
                for i in rows:
                    out[i] = (None, None, None, "there is no fitted model")
            elif name in kernels:
                fitted = np.array([np.asarray(parameters.iloc[i], dtype=float) for i in rows])
                for i, part in zip(rows, zip(*kernels[name].predict(fitted, np.datetime64(first, "D"), int(length), int(steps)))):
                    out[i] = _outcome(*part)
        return pd.DataFrame(out, columns=["mean", "lower", "upper", "error"])
    return run


def _spread_out(tasks: DataFrame) -> DataFrame:
    """One shuffle that deals fits over all cores.

    The rows are few bytes and much work, so adaptive coalescing by size would
    put them into one task; a stated partition count is left alone.
    """
    count = int(tasks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tasks.repartition(count)


def _forecast_rows(tasks: DataFrame, names: list[Column], chosen: tuple[str, ...]) -> DataFrame:
    """One row per forecast step of each task; a failed task keeps one row with its error."""
    run = _runner({m: KERNELS[m] for m in chosen})
    return _step_rows(_spread_out(tasks).withColumn("r", run("Model", "y", "first", "horizon")), names)


def _step_rows(fitted: DataFrame, names: list[Column]) -> DataFrame:
    steps = F.arrays_zip(
        F.col("r.mean").alias("m"), F.col("r.lower").alias("l"), F.col("r.upper").alias("u"),
        F.col("actual").alias("a"),
    )
    error = F.coalesce("reason", "r.error")
    opened = fitted.select(*names, "last", error.alias("error"), F.posexplode_outer(
        F.when(error.isNull(), steps)
    ).alias("pos", "s"))
    return opened.select(
        *names,
        (F.col("pos") + 1).alias("step"),
        cal.next_month("last", F.col("pos") + 1).alias("Date"),
        F.col("s.a").alias("actual"),
        F.col("s.m").alias("Forecast"),
        F.col("s.l").alias("Lower_CI"),
        F.col("s.u").alias("Upper_CI"),
        "error",
    )


def check_models(models: tuple[str, ...]) -> None:
    unknown = sorted(set(models) - set(KERNELS))
    if unknown:
        raise ModelTrainingError(f"unknown model(s) {unknown}; known: {sorted(KERNELS)}")


def forecast(
    panel: DataFrame, keys: tuple[str, ...] = (), model: str = "SARIMA", horizon: int = 3,
    date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """``horizon`` months ahead of every series: ``(keys..., Model, step, Date, Forecast, Lower_CI, Upper_CI, error)``."""
    check_models((model,))
    if horizon < 1:
        raise ModelTrainingError("the horizon must be at least 1")
    tasks = pack(panel, keys, date_col, value_col).select(
        *cols(keys), F.lit(model).alias("Model"), "y",
        cal.month_start(F.element_at("dates", 1)).alias("first"),
        F.element_at("dates", -1).alias("last"),
        F.lit(horizon).alias("horizon"), F.array().cast("array<double>").alias("actual"),
        F.lit(None).cast("string").alias("reason"),
    )
    return _forecast_rows(tasks, [*cols(keys), F.col("Model")], (model,)).drop("actual")


def evaluate(
    panel: DataFrame, keys: tuple[str, ...] = (), models: tuple[str, ...] = COMPARED, val_periods: int = 3,
    horizon: int = MAX_HORIZON, date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """Every model on every series, twice: on all but the last periods, and on everything.

    Rows ``(keys..., Model, split, step, Date, actual, Forecast, bounds, error)``
    with ``split`` = validation or future. A series shorter than
    ``2 * val_periods`` gets one row per model with the reason. All fits of all
    series are one job.
    """
    check_models(models)
    n = F.size("y")
    none = F.array().cast("array<double>")
    no_reason = F.lit(None).cast("string")

    def task(split: str, y: Column, last: Column, steps: int, actual: Column, reason: Column) -> Column:
        return F.struct(
            F.lit(split).alias("split"), y.alias("y"), last.alias("last"), F.lit(steps).alias("horizon"),
            actual.alias("actual"), reason.alias("reason"),
        )

    kept = F.greatest(n - val_periods, F.lit(0))
    newest = F.element_at("dates", -1)
    both = F.array(
        task("validation", F.slice("y", 1, kept), F.element_at("dates", F.greatest(kept, F.lit(1))), val_periods,
             F.slice("y", kept + 1, val_periods), no_reason),
        task("future", F.col("y"), newest, max(horizon, 3), none, no_reason),
    )
    reason = F.concat(F.lit("not enough periods for validation: "), n.cast("string"))
    refused = F.array(task("validation", none, newest, val_periods, none, reason))
    tasks = (
        pack(panel, keys, date_col, value_col)
        .select(
            *cols(keys), cal.month_start(F.element_at("dates", 1)).alias("first"),
            F.explode(F.array(*[F.lit(m) for m in models])).alias("Model"),
            F.when(n >= 2 * val_periods, both).otherwise(refused).alias("tasks"),
        )
        .select(*cols(keys), "first", "Model", F.explode("tasks").alias("t"))
        .select(*cols(keys), "first", "Model", "t.*")
    )
    return _forecast_rows(tasks, [*cols(keys), F.col("Model"), F.col("split")], models)


def comparison(evaluated: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """MAE, RMSE, MAPE and the first three future months per series and model, best RMSE first.

    A failed model has infinite errors, a failed full fit has null months. One
    aggregation over the evaluation rows.
    """
    valid = (F.col("split") == "validation") & F.col("actual").isNotNull() & F.col("Forecast").isNotNull()
    gap = F.when(valid, F.col("actual") - F.col("Forecast"))
    safe = F.when(F.col("actual") == 0, F.lit(1e-5)).otherwise(F.col("actual"))
    month = [
        F.max(F.when((F.col("split") == "future") & (F.col("step") == i), F.col("Forecast"))).alias(f"Forecast Month {i}")
        for i in (1, 2, 3)
    ]

    def or_inf(c: Column) -> Column:
        return F.coalesce(c, F.lit(float("inf")))

    return evaluated.groupBy(*cols(keys), "Model").agg(
        or_inf(F.avg(F.abs(gap))).alias("MAE"),
        or_inf(F.sqrt(F.avg(gap * gap))).alias("RMSE"),
        or_inf(F.avg(F.when(valid, F.abs(safe - F.col("Forecast")) / F.abs(safe)))).alias("MAPE"),
        *month,
        F.max("error").alias("error"),
    ).orderBy(*cols(keys), "RMSE", "Model")


def best_models(compared: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The model with the lowest RMSE per series, among those whose full fit succeeded."""
    return (
        compared.where(F.col("`Forecast Month 1`").isNotNull())
        .groupBy(*cols(keys))
        .agg(F.min_by(F.struct("Model", "MAE", "RMSE", "MAPE"), F.struct("RMSE", "Model")).alias("b"))
        .select(*cols(keys), "b.*")
    )


def best_forecast(evaluated: DataFrame, best: DataFrame, keys: tuple[str, ...] = (), horizon: int = 3) -> DataFrame:
    """The future months of each series under its best model."""
    future = evaluated.where((F.col("split") == "future") & (F.col("step") <= horizon))
    return future.join(best.select(*cols(keys), "Model"), [*keys, "Model"]).select(
        *cols(keys), "Model", "step", "Date", "Forecast", "Lower_CI", "Upper_CI"
    )


def validation_predictions(evaluated: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Actual and predicted values of the holdout, per series and model."""
    return evaluated.where((F.col("split") == "validation") & F.col("Forecast").isNotNull()).select(
        *cols(keys), "Model", "Date", "actual", "Forecast", "Lower_CI", "Upper_CI"
    )


def history_and_forecast(panel: DataFrame, future: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """History and forecast rows on one axis, told apart by ``kind``."""
    past = panel.select(*cols(keys), "Date", F.col("Sales").alias("value"), F.lit("history").alias("kind"))
    ahead = future.select(
        *cols(keys), "Date", F.col("Forecast").alias("value"), F.lit("forecast").alias("kind"), "Lower_CI", "Upper_CI"
    )
    return past.unionByName(ahead, allowMissingColumns=True)


def needs_retraining(compared: DataFrame, threshold: float = 0.15) -> DataFrame:
    """Models whose MAPE is above the drift threshold."""
    return compared.where(F.col("MAPE") > threshold)


def display_forecast(future: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Forecast table for display: year and month text, readable column names, two decimals."""
    return future.select(
        *cols(keys),
        F.date_format("Date", "yyyy-MMM").alias("Date"),
        F.round("Forecast", 2).alias("Pred Sales ($)"),
        F.round("Lower_CI", 2).alias("Lower Limit ($)"),
        F.round("Upper_CI", 2).alias("Upper Limit ($)"),
    )


def save_best(best: DataFrame, path: str) -> str:
    """Store the best forecasts (all steps) of a panel as a table."""
    best.write.mode("overwrite").parquet(path)
    return path


def load_best(spark: SparkSession, path: str, horizon: int = 3) -> DataFrame:
    """Stored best forecasts up to a horizon; an error when nothing was stored.

    The steps of a forecast do not depend on how far it goes, so a longer stored
    forecast answers every shorter horizon.
    """
    if not 1 <= horizon <= MAX_HORIZON:
        raise ModelTrainingError(f"the horizon must be within 1..{MAX_HORIZON}")
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no stored forecast at {path}: compare the models first") from error
        raise
    return stored.where(F.col("step") <= horizon)


def fit_models(
    panel: DataFrame, keys: tuple[str, ...] = (), models: tuple[str, ...] = COMPARED, date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """``(keys..., Model, first, last, n, parameters, error)``: every model fitted to every series, as numbers from which
    :func:`predict` forecasts any horizon. A series that cannot be fitted has a row with the reason."""
    check_models(models)
    tasks = pack(panel, keys, date_col, value_col).select(
        *cols(keys), F.explode(F.array(*[F.lit(m) for m in models])).alias("Model"),
        cal.month_start(F.element_at("dates", 1)).alias("first"), F.element_at("dates", -1).alias("last"),
        F.size("y").alias("n"), "y")
    fitted = _spread_out(tasks).withColumn("f", _fitter({m: KERNELS[m] for m in models})("Model", "y", "first"))
    return fitted.select(*cols(keys), "Model", "first", "last", "n", "f.parameters", "f.error")


def predict(fitted: DataFrame, keys: tuple[str, ...] = (), horizon: int = 3) -> DataFrame:
    """``horizon`` months ahead from :func:`fit_models`, without a fit: the rows that :func:`forecast` gives."""
    if horizon < 1:
        raise ModelTrainingError("the horizon must be at least 1")
    run = _predictor(dict(KERNELS))
    tasks = fitted.withColumnRenamed("error", "reason").withColumn("actual", F.array().cast("array<double>"))
    ready = tasks.withColumn("r", run("Model", "parameters", "first", "n", F.lit(horizon)))
    return _step_rows(ready, [*cols(keys), F.col("Model")]).drop("actual")


def save_models(fitted: DataFrame, path: str, best: DataFrame | None = None, keys: tuple[str, ...] = ()) -> str:
    """Store fitted models, those of ``best`` (:func:`best_models`) alone if it is given, as one table keyed by series and model."""
    if best is not None:
        chosen = best.select(*[F.col(f"`{k}`").alias(f"_of_{k}") for k in keys], F.col("Model").alias("_model"))
        same = F.col("Model") == F.col("_model")
        for k in keys:
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`"))
        fitted = fitted.join(chosen, same, "left_semi")
    fitted.write.mode("overwrite").parquet(path)
    return path


def load_models(spark: SparkSession, path: str) -> DataFrame:
    """Stored models; an error when nothing was stored."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no stored models at {path}: compare the models first") from error
        raise
