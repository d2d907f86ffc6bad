"""Series as one row each, for kernels that need a whole series at a time.

A packed row holds one array of values in date order. Its size is bounded by
the calendar because a panel has one row per period, which is checked. Kernels
run as Pandas UDFs over Arrow batches of packed rows, so one call serves many
series; Spark partitions and shuffles the work by the series keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import cols


def pack_rows(panel: DataFrame, keys: tuple[str, ...] = (), date_col: str = "Date") -> DataFrame:
    """``(keys..., obs)``: the rows of a series, all columns, as one array in date order.

    ``obs.d`` is the date. Fails at run time when a date occurs twice in a
    series; the check guards the array, so nothing can be read without it.
    """
    rest = [F.col(f"`{c}`") for c in panel.columns if c not in keys]
    row = F.struct(F.to_date(F.col(f"`{date_col}`")).alias("d"), *rest)
    packed = panel.groupBy(*cols(keys)).agg(F.sort_array(F.collect_list(row)).alias("obs"))
    message = F.lit("a series has two rows for one date: roll transactions up to periods first")
    distinct = F.size(F.array_distinct("obs.d")) == F.size("obs")
    return packed.where(F.size("obs") > 0).withColumn(
        "obs", F.when(distinct, F.col("obs")).otherwise(F.raise_error(message))
    )


def pack(
    panel: DataFrame, keys: tuple[str, ...] = (), date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """``(keys..., dates array<date>, y array<double>)``, one row per series."""
    value = F.col(f"`{value_col}`").cast("double").alias("v")
    pairs = panel.select(*cols(keys), F.col(f"`{date_col}`").alias("t"), value)
    return pack_rows(pairs, keys, "t").select(
        *cols(keys), F.col("obs.d").alias("dates"), F.col("obs.v").alias("y")
    )
