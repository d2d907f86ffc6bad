"""Whole batch jobs: read, clean, roll up, forecast, flag, segment, report, write."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..forecast import models
from ..operators import anomaly, clean, kpi, quality, rollup, segment, windows
from ..sources import files
from ..sources.schemas import SALES_REQUIRED, TITLES_REQUIRED
from ..sources.staging import hold
from . import report


def prepare_sales(raw: DataFrame, **options) -> DataFrame:
    """Checked, cleaned and featured transactions."""
    return clean.sales_features(clean.clean_sales(quality.require_rows(raw), **options))


def prepare_titles(raw: DataFrame, **options) -> DataFrame:
    """Checked, cleaned and featured titles."""
    return clean.title_features(clean.clean_titles(quality.require_rows(raw), **options))


class DataSet(NamedTuple):
    """How a kind of input is loaded and prepared: columns it must have, steps from raw text rows to clean ones in their
    order, and the name of the stored table."""

    required: tuple[str, ...]
    steps: tuple[Callable[[DataFrame], DataFrame], ...]
    table: str

    def prepare(self, spark: SparkSession, path: str) -> DataFrame:
        frame = quality.require_columns(files.load_csv(spark, path), self.required)
        for step in self.steps:
            frame = step(frame)
        return frame


DATA_SETS: dict[str, DataSet] = {
    "sales": DataSet(tuple(SALES_REQUIRED), (prepare_sales,), "train_clean"),
    "titles": DataSet(tuple(TITLES_REQUIRED), (prepare_titles,), "titles_clean"),
}


def register_data_set(name: str, required: tuple[str, ...], steps: tuple[Callable[[DataFrame], DataFrame], ...], table: str) -> None:
    """Add a kind of input, which :func:`preprocess_all` then takes under its name."""
    if name in DATA_SETS or any(d.table == table for d in DATA_SETS.values()):
        raise ValueError(f"there is a data set {name} or a table {table} already")
    DATA_SETS[name] = DataSet(required, steps, table)


def preprocess_all(spark: SparkSession, inputs: dict[str, str], target: str) -> dict[str, DataFrame]:
    """Clean and store every data set that is there; absent ones are left out.

    ``inputs`` maps names of ``DATA_SETS`` to CSV paths.
    """
    unknown = sorted(set(inputs) - set(DATA_SETS))
    if unknown:
        raise ValueError(f"unknown data set(s) {unknown}; known: {sorted(DATA_SETS)}")
    out = {}
    for name, path in inputs.items():
        try:
            clean_rows = DATA_SETS[name].prepare(spark, path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        out[name] = spark.read.parquet(files.save(clean_rows, f"{target}/{DATA_SETS[name].table}"))
    return out


def weekly_anomalies(clean_sales: DataFrame, target: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Weekly series, detectors, and (with a target) the full and the flagged table."""
    flagged = anomaly.detect_anomalies(rollup.weekly(clean_sales, keys), keys)
    if target:
        flagged = clean_sales.sparkSession.read.parquet(files.save(flagged, f"{target}/weekly_sales_anomalies"))
        files.save(anomaly.anomalies_only(flagged), f"{target}/anomalies_only")
    return flagged


def product_segments(clean_sales: DataFrame, target: str | None = None, max_k: int = 8, starts: int = segment.STARTS):
    """Features, elbow table, segments and their projection; stored with a target."""
    key = segment.product_key(clean_sales)
    scaled = hold(segment.scale_features(segment.product_features(clean_sales, key)), "scaled-features")
    inertia = segment.elbow(scaled, max_k, starts)
    segmented = segment.segment(scaled, starts=starts)
    if target:
        stored = segmented.drop(*[f"z_{f}" for f in segment.FEATURES])
        segmented = clean_sales.sparkSession.read.parquet(files.save(stored, f"{target}/segmented_products"))
        files.save(inertia, f"{target}/elbow")
        files.save(segment.project(segmented, key), f"{target}/segment_projection")
    return segmented, inertia


def run_all(
    raw_sales: DataFrame, target: str, keys: tuple[str, ...] = (), horizon: int = 3,
    compared: tuple[str, ...] = models.COMPARED, starts: int = segment.STARTS, **cleaning,
) -> dict[str, DataFrame]:
    """The whole batch job from raw transactions to stored tables.

    Every stage is written once and read back, so nothing is computed twice and
    a lost executor costs at most one stage. ``keys`` makes the series, forecasts
    and anomalies a panel.
    """
    spark = raw_sales.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        return spark.read.parquet(files.save(df, f"{target}/{name}"))

    facts = prepare_sales(raw_sales, **cleaning)
    files.save(facts, f"{target}/train_clean", partition_by=("Year", "Month"))
    facts = spark.read.parquet(f"{target}/train_clean")
    out = {"train_clean": facts}
    for name, period in (("daily_sales", "day"), ("weekly_sales", "week"), ("monthly_sales", "month")):
        out[name] = stored(rollup.roll_up(facts, period, keys), name)
    evaluated = stored(models.evaluate(out["monthly_sales"], keys, compared), "model_evaluation")
    out["model_comparison"] = stored(models.comparison(evaluated, keys), "model_comparison")
    best = models.best_models(out["model_comparison"], keys)
    out["best_forecast"] = stored(models.best_forecast(evaluated, best, keys, models.MAX_HORIZON), "best_forecast")
    out["forecast_future"] = stored(models.load_best(spark, f"{target}/best_forecast", horizon), "forecast_future")
    out["weekly_sales_anomalies"] = stored(
        anomaly.detect_anomalies(out["weekly_sales"], keys), "weekly_sales_anomalies"
    )
    out["anomalies_only"] = stored(anomaly.anomalies_only(out["weekly_sales_anomalies"]), "anomalies_only")
    out["segmented_products"], out["elbow"] = product_segments(facts, target, starts=starts)
    out["report_comparison"] = stored(report.comparison_table(out["model_comparison"], keys), "report_comparison")
    out["report_anomalies"] = stored(report.anomaly_table(out["weekly_sales_anomalies"], keys), "report_anomalies")
    out["report_segments"] = stored(report.segment_table(out["segmented_products"]), "report_segments")
    out["report_kpis"] = stored(kpi.report_kpis(facts), "report_kpis")
    out["chart_monthly_trend"] = stored(windows.trailing_mean(out["monthly_sales"], keys), "chart_monthly_trend")
    return out
