"""The tables behind the sales dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import clean, kpi, rollup, windows


def sales_dashboard(df: DataFrame, region: str = clean.ALL, category: str = clean.ALL) -> dict[str, DataFrame]:
    """Lazy tables of the dashboard for featured, clean transactions under a filter."""
    chosen = clean.narrow(df, region, category)
    return {
        "regions": clean.distinct_values(df, "Region"),
        "categories": clean.distinct_values(df, "Category"),
        "kpis": kpi.sales_kpis(chosen),
        "monthly_trend": windows.trailing_mean(rollup.monthly(chosen)),
        "category_breakdown": kpi.sales_hierarchy(chosen) if "Sub-Category" in df.columns
        else kpi.sales_by(chosen, "Category"),
        "region_sales": kpi.sales_by(chosen, "Region"),
        "heatmap": kpi.heatmap(chosen),
    }
