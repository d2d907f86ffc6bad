"""Gap-free daily, weekly, monthly and yearly series from transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal

# period start of a transaction date, and the interval between two periods
PERIODS = {
    "day": (cal.day, "INTERVAL 1 DAY"),
    "week": (cal.closing_monday, "INTERVAL 7 DAYS"),
    "month": (cal.month_start, "INTERVAL 1 MONTH"),
}


def _cols(keys: tuple[str, ...]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def fill_gaps(
    totals: DataFrame,
    period: str,
    keys: tuple[str, ...] = (),
    date_col: str = "Date",
    value_col: str = "Sales",
    span: str = "series",
) -> DataFrame:
    """One row per period from first to last, absent periods 0.

    Each row is stretched up to the period before the next one of its series, so
    the calendar needs no join: one window over period totals. ``span="global"``
    stretches every series over the whole data's first and last period.
    """
    step = F.expr(PERIODS[period][1])
    d, v = F.col(f"`{date_col}`"), F.col(f"`{value_col}`")
    w = Window.partitionBy(*_cols(keys)).orderBy(d)
    following = F.lead(d).over(w)
    if span == "global":
        bounds = totals.agg(F.struct(F.min(d).alias("first"), F.max(d).alias("last"))).scalar()
        marked = totals.select(
            *_cols(keys), d, v,
            F.when(F.lag(d).over(w).isNull(), bounds["first"]).otherwise(d).alias("_from"),
            F.coalesce((following - step).cast("date"), bounds["last"]).alias("_to"),
        )
    else:
        marked = totals.select(
            *_cols(keys), d, v, d.alias("_from"), F.coalesce((following - step).cast("date"), d).alias("_to")
        )
    return marked.withColumn("_slot", F.explode(F.sequence(F.col("_from"), F.col("_to"), step))).select(
        *_cols(keys),
        F.col("_slot").alias(date_col),
        F.when(F.col("_slot") == d, v).otherwise(F.lit(0.0)).alias(value_col),
    )


def roll_up(
    df: DataFrame,
    period: str,
    keys: tuple[str, ...] = (),
    date_col: str = "Order Date",
    value_col: str = "Sales",
    span: str = "series",
) -> DataFrame:
    """Gap-free period totals as ``(keys..., Date, Sales)``."""
    bucket, _ = PERIODS[period]
    totals = (
        df.where(F.col(f"`{date_col}`").isNotNull())
        .groupBy(*_cols(keys), bucket(date_col).alias("Date"))
        .agg(F.coalesce(F.sum(F.col(f"`{value_col}`")), F.lit(0.0)).alias("Sales"))
    )
    return fill_gaps(totals, period, keys, span=span)


def daily(df: DataFrame, keys: tuple[str, ...] = (), **kw) -> DataFrame:
    return roll_up(df, "day", keys, **kw)


def weekly(df: DataFrame, keys: tuple[str, ...] = (), **kw) -> DataFrame:
    """Weeks run Tuesday to Monday and carry the date of the closing Monday."""
    return roll_up(df, "week", keys, **kw)


def monthly(df: DataFrame, keys: tuple[str, ...] = (), **kw) -> DataFrame:
    return roll_up(df, "month", keys, **kw)


def yearly(titles: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Global sales of titles per year, in year order."""
    return (
        titles.groupBy(*_cols(keys), "Year").agg(F.sum("Global_Sales").alias("Global_Sales"))
        .orderBy(*_cols(keys), "Year")
    )


def stack_dimensions(df: DataFrame, dimensions: list[str], period: str = "month", **kw) -> DataFrame:
    """The series of every value of several, possibly overlapping, dimensions.

    One scan: each row is handed out once per dimension as (dimension, value),
    and the partial aggregation collapses the copies before the shuffle.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(f"`{c}`").cast("string").alias("value")) for c in dimensions
    ])
    date_col, value_col = kw.get("date_col", "Order Date"), kw.get("value_col", "Sales")
    long = df.select(
        F.explode(pairs).alias("p"), F.col(f"`{date_col}`"), F.col(f"`{value_col}`")
    ).select("p.*", F.col(f"`{date_col}`"), F.col(f"`{value_col}`"))
    return roll_up(long, period, ("dimension", "value"), **kw)
