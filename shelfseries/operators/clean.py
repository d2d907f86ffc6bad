"""Cleaning steps and the two whole cleaning chains."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import numeric as num
from ..sources import schemas
from ..sources.staging import hold
from . import quality, quantiles

DATE_FORMATS = ("d/M/yyyy", "yyyy-MM-dd", "M/d/yyyy")
ALL = "All"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def parse_date(df: DataFrame, name: str, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """The column as a date: first matching format wins, unparseable is null."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(_c(name))
    text = F.trim(_c(name).cast("string"))
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in formats])


def date_format_counts(df: DataFrame, name: str, formats: Iterable[str] = DATE_FORMATS) -> DataFrame:
    """How many rows each format parses first; the last row counts the unparseable."""
    text = F.trim(_c(name).cast("string"))
    used = F.lit("none")
    for f in reversed(list(formats)):
        used = F.when(F.try_to_timestamp(text, F.lit(f)).isNotNull(), F.lit(f)).otherwise(used)
    return df.groupBy(used.alias("date_format")).agg(F.count(F.lit(1)).alias("row_count"))


def to_number(name: str) -> Column:
    """The column as a double, null when it is not a number."""
    value = _c(name).try_cast("double")
    return F.when(~F.isnan(value), value)


def trim_text(df: DataFrame, names: Iterable[str], unknown: str | None = None) -> DataFrame:
    """Trim the named columns that exist; nulls become ``unknown`` when it is given."""
    changes = {}
    for name in names:
        if name in df.columns:
            trimmed = F.trim(_c(name))
            changes[name] = trimmed if unknown is None else F.coalesce(trimmed, F.lit(unknown))
    return df.withColumns(changes) if changes else df


def keep_years(df: DataFrame, name: str = "Year", first: int = 1970, last: int | None = None) -> DataFrame:
    """Rows whose year is a number within ``[first, last]``; ``last`` defaults to this year."""
    last = last or datetime.date.today().year
    return (
        df.withColumn(name, to_number(name))
        .where(_c(name).between(first, last))
        .withColumn(name, _c(name).cast("int"))
    )


def narrow(df: DataFrame, region: str = ALL, category: str = ALL) -> DataFrame:
    """Rows of one region and/or category; ``"All"`` leaves a dimension open."""
    if region != ALL:
        df = df.where(_c("Region") == region)
    if category != ALL:
        df = df.where(_c("Category") == category)
    return df


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    """The sorted distinct values of a column, for a filter list."""
    return df.select(_c(name)).distinct().orderBy(_c(name))


def clean_sales(
    df: DataFrame,
    formats: Iterable[str] = DATE_FORMATS,
    cap_factor: float | None = 3.0,
    cap_method: str = "exact",
) -> DataFrame:
    """Raw transactions to clean ones.

    Names stripped, whole-row duplicates dropped, dates and Sales coerced (rows
    without either are dropped), negative Sales set to 0, text trimmed, Sales
    capped at wide IQR fences. The frame is held before the capping pass, so the
    de-duplication shuffle runs once.
    """
    df = quality.require_columns(strip_column_names(df), schemas.SALES_REQUIRED)
    df = drop_exact_duplicates(df)
    changes = {"Order Date": parse_date(df, "Order Date", formats), "Sales": to_number("Sales")}
    if "Ship Date" in df.columns:
        changes["Ship Date"] = parse_date(df, "Ship Date", formats)
    df = (
        df.withColumns(changes)
        .na.drop(subset=["Order Date", "Sales"])
        .withColumn("Sales", num.non_negative("Sales"))
    )
    df = trim_text(df, schemas.SALES_TEXT)
    if cap_factor is None:
        return df
    return quantiles.winsorize(hold(df, "sales-uncapped"), "Sales", cap_factor, cap_method)


def sales_features(df: DataFrame) -> DataFrame:
    """Calendar features, and shipping days and profit margin where their columns exist."""
    changes = cal.calendar_columns("Order Date")
    if "Ship Date" in df.columns:
        changes["ShippingDays"] = num.shipping_days("Ship Date", "Order Date")
    if "Profit" in df.columns:
        profit = to_number("Profit")
        changes["Profit"] = profit
        changes["ProfitMargin"] = num.margin(profit, "Sales")
    return df.withColumns(changes)


def clean_titles(
    df: DataFrame,
    last_year: int | None = None,
    cap_factor: float | None = 3.0,
    cap_method: str = "exact",
) -> DataFrame:
    """Raw title rows to clean ones: plausible years, non-negative sales, known text, capped totals."""
    df = quality.require_columns(strip_column_names(df), schemas.TITLES_REQUIRED)
    df = keep_years(drop_exact_duplicates(df), "Year", last=last_year)
    numbers = [c for c in [*schemas.REGIONAL_SALES, "Global_Sales"] if c in df.columns]
    df = df.withColumns({c: num.non_negative(to_number(c)) for c in numbers})
    df = trim_text(df, schemas.TITLES_TEXT, unknown="Unknown")
    if cap_factor is None:
        return df
    return quantiles.winsorize(hold(df, "titles-uncapped"), "Global_Sales", cap_factor, cap_method)


def title_features(df: DataFrame) -> DataFrame:
    """Release date, decade, and regional shares when all four regional columns exist."""
    changes = {"ReleaseDate": num.release_date("Year"), "Decade": num.decade("Year")}
    if set(schemas.REGIONAL_SALES) <= set(df.columns):
        for name in schemas.REGIONAL_SALES:
            changes[name.replace("_Sales", "_Share")] = num.share(name, "Global_Sales")
    return df.withColumns(changes)
