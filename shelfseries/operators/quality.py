"""Schema checks, data-quality counters and profiles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DataValidationError


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """``df`` itself; an error names the required columns it lacks. Runs no job."""
    present = {c.strip() for c in df.columns}
    missing = sorted(set(required) - present)
    if missing:
        raise DataValidationError(f"missing required column(s) {missing}; found {df.columns}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    """``df`` itself; an error when it has no row. Stops at the first row."""
    if df.isEmpty():
        raise DataValidationError("the input has no rows")
    return df


def missingness(df: DataFrame) -> DataFrame:
    """Null count and percentage (2 decimals) of every column that has nulls.

    One pass: all counts come from a single aggregate row, which is then turned
    on its side.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("missing_count"))
        for i, c in enumerate(df.columns)
    ])
    return (
        counts.select("n", F.explode(pairs).alias("p"))
        .select(
            "p.column_name",
            "p.missing_count",
            F.round(F.col("p.missing_count") / F.col("n") * 100, 2).alias("missing_pct"),
        )
        .where("missing_count > 0")
        .orderBy(F.desc("missing_count"), "column_name")
    )


def cleaning_counts(
    df: DataFrame,
    parsed_date: Column,
    number: Column,
    lower: float | None = None,
    upper: float | None = None,
) -> DataFrame:
    """One row of counters for raw rows: how many, bad dates, bad numbers, negatives, out of bounds."""
    capped = F.lit(0).cast("long") if lower is None else F.count_if((number < lower) | (number > upper))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(parsed_date.isNull()).alias("bad_dates"),
        F.count_if(number.isNull()).alias("bad_numbers"),
        F.count_if(number < 0).alias("negatives"),
        capped.alias("capped"),
    )


def duplicate_count(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """How many rows a whole-row (or given-column) de-duplication would remove."""
    cols = [F.col(f"`{c}`") for c in (columns or df.columns)]
    return df.groupBy(*cols).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def profile(df: DataFrame) -> DataFrame:
    """Shape and types: one row per column with its type and the row count."""
    types = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("data_type"))
        for i, (c, t) in enumerate(df.dtypes)
    ])
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.explode(types).alias("t"), "row_count")
        .select("t.*", "row_count")
    )


def head(df: DataFrame, order: Iterable[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*[F.col(f"`{c}`") for c in order]).limit(n)


def history_check(panel: DataFrame, keys: tuple[str, ...] = (), val_periods: int = 3) -> DataFrame:
    """Per series: its length and whether it can be split for validation (n >= 2 * val_periods)."""
    cols = [F.col(f"`{k}`") for k in keys]
    return panel.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_periods")).withColumn(
        "enough_history", F.col("n_periods") >= 2 * val_periods
    )
