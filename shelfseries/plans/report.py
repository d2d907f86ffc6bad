"""The tables of the executive report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import money_text, percent_text
from ..operators import kpi, segment
from ..operators.anomaly import largest_anomalies
from ..operators.windows import cols


def comparison_table(compared: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Model errors as text, best first within a series."""
    return compared.orderBy(*cols(keys), "RMSE", "Model").select(
        *cols(keys), F.col("Model").alias("Forecasting Model"), money_text("MAE").alias("MAE"),
        money_text("RMSE").alias("RMSE"), percent_text("MAPE").alias("MAPE"),
    )


def anomaly_table(flagged: DataFrame, keys: tuple[str, ...] = (), k: int = 5) -> DataFrame:
    """The largest consensus anomalies as text with their flag count."""
    return largest_anomalies(flagged, k, keys).select(
        *cols(keys),
        F.date_format("Date", "yyyy-MM-dd").alias("Date"),
        money_text("Sales").alias("Sales"),
        money_text("Rolling_Mean").alias("Rolling Mean"),
        F.concat(F.lit("Spike (Flag Count: "), F.col("Anomaly_Vote_Count").cast("string"), F.lit(")")).alias(
            "Reason / Flag Count"
        ),
    )


def segment_table(segmented: DataFrame) -> DataFrame:
    """Products per segment with the one-line strategy, largest first."""
    sized = segment.with_strategy(segment.segment_sizes(segmented))
    return sized.orderBy(F.desc("Product_Count"), "ClusterLabel").select(
        F.col("ClusterLabel").alias("Demand Segment"),
        F.format_number("Product_Count", 0).alias("Product Count"),
        F.col("Core_Strategy").alias("Core Strategy"),
    )


def headline(best: DataFrame, flagged: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: best model and its MAPE, number of anomalies, line count, total and mean monthly sales."""
    facts = kpi.report_kpis(clean).select(F.struct("*")).scalar()
    return best.select(
        F.col("Model").alias("best_model"), F.col("MAPE").alias("best_mape"),
        flagged.agg(F.sum("Is_Anomaly")).scalar().alias("anomalies"), facts.alias("f"),
    ).select("best_model", "best_mape", "anomalies", "f.*")
