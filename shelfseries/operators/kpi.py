"""Dashboard and report aggregates over clean transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def sales_by(df: DataFrame, *dimensions: str) -> DataFrame:
    """Total sales per value of the dimensions, largest first."""
    return (
        df.groupBy(*[_c(d) for d in dimensions]).agg(F.sum("Sales").alias("Sales"))
        .orderBy(F.desc("Sales"), *[_c(d) for d in dimensions])
    )


def sales_hierarchy(df: DataFrame, parent: str = "Category", child: str = "Sub-Category") -> DataFrame:
    """Sales of every child, parent and the whole; ``level`` is 2, 1, 0 and absent labels are null."""
    return (
        df.rollup(_c(parent), _c(child))
        .agg(F.sum("Sales").alias("Sales"), (2 - F.grouping(_c(parent)) - F.grouping(_c(child))).cast("int").alias("level"))
    )


def years_of(df: DataFrame, date_col: str = "Order Date") -> list[int]:
    """Every year from first to last: two scalars from one aggregate."""
    first, last = df.agg(F.year(F.min(_c(date_col))), F.year(F.max(_c(date_col)))).first()
    return [] if first is None else list(range(first, last + 1))


def region_by_year(df: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Region x year sales; a region without sales in a year has null. The column list is bounded by the calendar."""
    years = years if years is not None else years_of(df)
    return df.groupBy("Region").pivot("Year", years).agg(F.sum("Sales"))


def year_by_month(df: DataFrame) -> DataFrame:
    """Year x month-name sales, months in calendar order."""
    return df.groupBy("Year").pivot("MonthName", cal.MONTH_NAMES).agg(F.sum("Sales")).orderBy("Year")


def heatmap(
    df: DataFrame, index: str = "MonthName", columns: str = "DayName", values: str = "Sales",
    index_order: list[str] | None = None, column_order: list[str] | None = None,
) -> DataFrame:
    """Index x columns sums with absent cells 0, labels in calendar order.

    Labels that never occur keep no row; a column label that never occurs keeps
    a column of zeros, because the column list is fixed before the job runs.
    """
    index_order = cal.MONTH_NAMES if index_order is None and index == "MonthName" else index_order
    column_order = cal.DAY_NAMES if column_order is None and columns == "DayName" else column_order
    pivoted = (
        df.groupBy(_c(index)).pivot(columns, column_order).agg(F.sum(_c(values))).na.fill(0.0)
    )
    return pivoted.orderBy(cal.position_in(index_order, index) if index_order else _c(index))


def mean_shipping_days(df: DataFrame) -> DataFrame:
    """Mean ShippingDays per region, and overall as the row with a null region."""
    return df.rollup("Region").agg(F.avg("ShippingDays").alias("mean_shipping_days"))


def sales_kpis(df: DataFrame) -> DataFrame:
    """Total, number of lines, mean per line and mean profit margin (0 without that column)."""
    has_margin = "ProfitMargin" in df.columns
    return df.agg(
        F.sum("Sales").alias("total_sales"),
        F.count(F.lit(1)).alias("line_count"),
        F.avg("Sales").alias("avg_line_sales"),
        (F.avg("ProfitMargin") if has_margin else F.lit(0.0)).alias("avg_profit_margin"),
    )


def report_kpis(df: DataFrame) -> DataFrame:
    """Line count, total sales and the mean of the monthly totals, in two aggregation steps."""
    months = df.groupBy("YearMonth").agg(F.sum("Sales").alias("s"), F.count(F.lit(1)).alias("n"))
    return months.agg(
        F.sum("n").alias("line_count"), F.sum("s").alias("total_sales"), F.avg("s").alias("avg_monthly_sales")
    )


def steady_growth(df: DataFrame, dimension: str = "Region") -> DataFrame:
    """Whether a dimension's sales rose in every year after its first."""
    w = Window.partitionBy(_c(dimension)).orderBy("Year")
    yearly = df.groupBy(_c(dimension), "Year").agg(F.sum("Sales").alias("s"))
    return (
        yearly.withColumn("prev", F.lag("s").over(w)).where(F.col("prev").isNotNull())
        .groupBy(_c(dimension)).agg(F.every(F.col("s") > F.col("prev")).alias("always_grew"))
    )


def anomaly_kpis(flagged: DataFrame, keys: tuple[str, ...] = (), value_col: str = "Sales") -> DataFrame:
    """Flag counts per detector, consensus count and share, and the largest flagged value (0 if none)."""
    hit = F.col("Is_Anomaly") == 1
    return flagged.groupBy(*[_c(k) for k in keys]).agg(
        F.sum("Is_Anomaly").alias("anomalies"),
        F.avg("Is_Anomaly").alias("anomaly_ratio"),
        F.coalesce(F.max(F.when(hit, _c(value_col))), F.lit(0.0)).alias("max_spike"),
        F.sum("Anomaly_Z").alias("z_flags"),
        F.sum("Anomaly_Rolling").alias("rolling_flags"),
        F.sum("Anomaly_IForest").alias("forest_flags"),
    )


def error_metrics(
    scored: DataFrame, keys: tuple[str, ...] = (), actual: str = "actual", predicted: str = "Forecast",
) -> DataFrame:
    """MAE, RMSE and MAPE (a fraction; an actual of 0 counts as 1e-5 in MAPE only)."""
    y, p = _c(actual), _c(predicted)
    safe = F.when(y == 0, F.lit(1e-5)).otherwise(y)
    return scored.groupBy(*[_c(k) for k in keys]).agg(
        F.avg(F.abs(y - p)).alias("MAE"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("RMSE"),
        F.avg(F.abs(safe - p) / F.abs(safe)).alias("MAPE"),
    )
