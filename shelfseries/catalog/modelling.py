"""Forecasting, stationarity, forest and segmentation queries, which SQL cannot express."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..forecast import boosted, models
from ..operators import anomaly, clean, forest, rollup, segment, tsstats
from ..plans import report, star
from ..sources.staging import hold, new_path
from .base import query, rounded

REGION = ("Region",)


def _monthly(spark, folder, *keys):
    return rollup.monthly(star.sales(spark, folder, "Order Date", "Sales", *keys), keys)


def _weekly(spark, folder, *keys):
    return rollup.weekly(star.sales(spark, folder, "Order Date", "Sales", *keys), keys)


@query("stationarity")
def stationarity(spark, folder):
    return tsstats.dickey_fuller(_monthly(spark, folder, "Region"), REGION)


@query("partial_autocorrelation")
def partial_autocorrelation(spark, folder):
    return tsstats.partial_autocorrelation(_monthly(spark, folder, "Region"), REGION)


@query("forecast_sarima")
def forecast_sarima(spark, folder):
    return models.forecast(_monthly(spark, folder, "Region"), REGION, "SARIMA")


@query("forecast_trend_seasonal")
def forecast_trend_seasonal(spark, folder):
    return models.forecast(_monthly(spark, folder, "State"), ("State",), "TrendSeasonal")


@query("forecast_trend_seasonal_ratio")
def forecast_trend_seasonal_ratio(spark, folder):
    return models.forecast(_monthly(spark, folder, "State"), ("State",), "TrendSeasonalRatio")


@query("forecast_boosted")
def forecast_boosted(spark, folder):
    return models.forecast(_monthly(spark, folder, "Region"), REGION, "BoostedTrees")


@query("forecast_pooled_boosting")
def forecast_pooled_boosting(spark, folder):
    return boosted.pooled_boosting(_monthly(spark, folder, "Region"), REGION, horizon=3)


def _evaluated(spark, folder, *keys):
    # the fits are the dear part: they run once, whatever is derived from them
    return hold(models.evaluate(_monthly(spark, folder, *keys), keys), "evaluation")


@query("model_comparison")
def model_comparison(spark, folder):
    return models.comparison(_evaluated(spark, folder, "Region"), REGION)


@query("whole_business_comparison")
def whole_business_comparison(spark, folder):
    return models.comparison(_evaluated(spark, folder))


@query("validation_predictions")
def validation_predictions(spark, folder):
    return models.validation_predictions(_evaluated(spark, folder, "Region"), REGION)


@query("best_model_forecast")
def best_model_forecast(spark, folder):
    evaluated = _evaluated(spark, folder, "Region")
    best = models.best_models(models.comparison(evaluated, REGION), REGION)
    return models.best_forecast(evaluated, best, REGION, horizon=6)


@query("stored_model_forecast")
def stored_model_forecast(spark, folder):
    """The same six months from the stored parameters of the best models: no series is fitted to predict them."""
    panel = hold(_monthly(spark, folder, "Region"), "panel")
    best = models.best_models(models.comparison(hold(models.evaluate(panel, REGION), "evaluation"), REGION), REGION)
    path = models.save_models(models.fit_models(panel, REGION), new_path(spark, "models"), best, REGION)
    ahead = models.predict(models.load_models(spark, path), REGION, horizon=6)
    return ahead.select("Region", "Model", "step", "Date", "Forecast", "Lower_CI", "Upper_CI")


@query("forecast_display")
def forecast_display(spark, folder):
    return models.display_forecast(models.forecast(_monthly(spark, folder, "Region"), REGION, "TrendSeasonal", 6), REGION)


@query("history_and_forecast")
def history_and_forecast(spark, folder):
    panel = _monthly(spark, folder, "Category")
    return models.history_and_forecast(panel, models.forecast(panel, ("Category",), "TrendSeasonal"), ("Category",))


@query("segment_forecasts")
def segment_forecasts(spark, folder):
    lines = star.sales(spark, folder, "Order Date", "Sales", "Category", "Region")
    panel = rollup.stack_dimensions(lines, ["Category", "Region"])
    return models.forecast(panel, ("dimension", "value"), "TrendSeasonal")


@query("drift_alerts")
def drift_alerts(spark, folder):
    return models.needs_retraining(models.comparison(_evaluated(spark, folder, "Region"), REGION))


@query("forest_scores")
def forest_scores(spark, folder):
    return anomaly.forest_scores(_weekly(spark, folder, "Region"), REGION)


@query("transaction_forest")
def transaction_forest(spark, folder):
    """Order lines whose amount is easiest to isolate: one series of all lines, without keys."""
    lines = star.sales(spark, folder, "Order ID", "Order Date", "Region", "Sales")
    return forest.forest_scores(lines, contamination=0.01).where("Anomaly_IForest = 1")


@query("weekly_anomalies")
def weekly_anomalies(spark, folder):
    return anomaly.detect_anomalies(_weekly(spark, folder, "Region"), REGION)


@query("whole_business_anomalies")
def whole_business_anomalies(spark, folder):
    return anomaly.anomalies_only(anomaly.detect_anomalies(_weekly(spark, folder)))


@query("anomalies_under_settings")
def anomalies_under_settings(spark, folder):
    settings = [
        {"name": "default"},
        {"name": "strict", "z_threshold": 3.0, "rolling_k": 3.0, "contamination": 0.01},
        {"name": "loose", "z_threshold": 1.5, "rolling_k": 1.5, "rolling_window": 12, "contamination": 0.1},
    ]
    return anomaly.detect_under_settings(_weekly(spark, folder, "Region"), settings, REGION)


@query("report_anomalies")
def report_anomalies(spark, folder):
    return report.anomaly_table(anomaly.detect_anomalies(_weekly(spark, folder, "Region"), REGION), REGION)


@query("report_comparison")
def report_comparison(spark, folder):
    return report.comparison_table(models.comparison(_evaluated(spark, folder, "Region"), REGION), REGION)


@query("report_headline")
def report_headline(spark, folder):
    """Best model of the whole business with its error, number of flagged weeks, and the report's totals."""
    best = models.best_models(models.comparison(_evaluated(spark, folder)))
    lines = clean.sales_features(star.sales(spark, folder, "Order Date", "Sales"))
    return report.headline(best, anomaly.detect_anomalies(_weekly(spark, folder)), lines)


def _scaled(spark, folder):
    lines = star.sales(spark, folder, "Order ID", "Order Date", "Product Name", "Category", "Sub-Category", "Sales")
    return segment.scale_features(segment.product_features(clean.sales_features(lines)))


STARTS = segment.STARTS


@query("segment_elbow")
def segment_elbow(spark, folder):
    return segment.elbow(_scaled(spark, folder), max_k=8, starts=STARTS)


@query("product_segments")
def product_segments(spark, folder):
    return segment.segment(_scaled(spark, folder), starts=STARTS)


@query("segment_profile")
def segment_profile(spark, folder):
    return segment.cluster_profile(segment.segment(_scaled(spark, folder), starts=STARTS))


@query("segment_projection")
def segment_projection(spark, folder):
    return segment.project(segment.segment(_scaled(spark, folder), starts=STARTS), "Product Name")


@query("report_segments")
def report_segments(spark, folder):
    return report.segment_table(segment.segment(_scaled(spark, folder), starts=STARTS))


@query("first_segmented_products")
def first_segmented_products(spark, folder):
    segmented = segment.segment(_scaled(spark, folder), starts=STARTS)
    return rounded(segmented.orderBy(F.desc("Total_Sales"), "Product Name").limit(10), 4, *segment.FEATURES)
