"""Ordered computations over panels.

A panel holds one row per (keys, Date); the window of one series is therefore
bounded by the calendar, never by the number of transactions. ``per_period``
enforces it where a series is handled as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import flag

#: Half the size of any centred band, in stretched positions; the most rows of a band.
_HALF, MOST_BAND = 1 << 32, 1 << 14


def cols(keys: tuple[str, ...]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def ordered(keys: tuple[str, ...], date_col: str = "Date", descending: bool = False):
    d = F.col(f"`{date_col}`")
    return Window.partitionBy(*cols(keys)).orderBy(d.desc() if descending else d)


def per_period(panel: DataFrame, keys: tuple[str, ...], date_col: str, value_col: str) -> DataFrame:
    """The panel, failing at run time on two rows of one series with the same date.

    Uses the partitioning and order of the windows that follow, so it adds no
    shuffle or sort.
    """
    d, v = F.col(f"`{date_col}`"), F.col(f"`{value_col}`")
    repeated = F.lag(d).over(ordered(keys, date_col)) == d
    message = F.lit("a series has two rows for one date: roll transactions up to periods first")
    return panel.withColumn(value_col, F.when(repeated, F.raise_error(message).cast("double")).otherwise(v))


def trailing_mean(
    panel: DataFrame, keys: tuple[str, ...] = (), periods: int = 3,
    date_col: str = "Date", value_col: str = "Sales", name: str = "Rolling_3M",
) -> DataFrame:
    """Mean of this and the preceding ``periods - 1`` rows, as many as there are."""
    w = ordered(keys, date_col).rowsBetween(-(periods - 1), 0)
    return panel.withColumn(name, F.avg(F.col(f"`{value_col}`")).over(w))


def z_scores(
    panel: DataFrame, keys: tuple[str, ...] = (), threshold: float = 2.0, value_col: str = "Sales",
) -> DataFrame:
    """Z_Score by sample deviation within the series (0 deviation counts as 1e-5), and its flag."""
    v = F.col(f"`{value_col}`")
    w = Window.partitionBy(*cols(keys))
    spread = F.stddev_samp(v).over(w)
    spread = F.when(spread == 0, F.lit(1e-5)).otherwise(spread)
    return panel.withColumn("Z_Score", (v - F.avg(v).over(w)) / spread).withColumn(
        "Anomaly_Z", flag(F.abs("Z_Score") > threshold)
    )


def centred_bands(
    panel: DataFrame, keys: tuple[str, ...] = (), window: int = 8, k: float = 2.0,
    date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """Centred rolling mean and sample deviation, and the flag outside mean +- k deviations.

    A series of n rows uses ``max(3, min(window, n // 3))`` rows, of at most ``MOST_BAND``. One frame serves every
    size: positions are stretched by the reciprocal of their series' size, which puts half a size at the same distance
    in all series. An even size takes the row half a size back and not the one half a size ahead.
    """
    if window > MOST_BAND:
        raise ValueError(f"a band has at most {MOST_BAND} rows")
    v = F.col(f"`{value_col}`")
    third = F.floor(F.count(F.lit(1)).over(Window.partitionBy(*cols(keys))) / 3)
    size = F.greatest(F.lit(3), F.least(F.lit(window), third))
    place = F.row_number().over(ordered(keys, date_col)) * F.floor(F.lit(2 * _HALF) / size)
    frame = Window.partitionBy(*cols(keys)).orderBy("_place").rangeBetween(-_HALF, _HALF - MOST_BAND)
    banded = panel.withColumn("_place", place.cast("long")).withColumns({
        "Rolling_Mean": F.avg(v).over(frame), "Rolling_Std": F.coalesce(F.stddev_samp(v).over(frame), F.lit(0.0))})
    outside = (v > F.col("Rolling_Mean") + k * F.col("Rolling_Std")) | (
        v < F.col("Rolling_Mean") - k * F.col("Rolling_Std")
    )
    return banded.withColumn("Anomaly_Rolling", flag(outside)).drop("_place")


def lagged(
    panel: DataFrame, keys: tuple[str, ...] = (), lags: int = 3, date_col: str = "Date", value_col: str = "Sales",
    complete: bool = True,
) -> DataFrame:
    """Columns lag_1..lag_n; rows without a full history are dropped unless ``complete`` is off."""
    w = ordered(keys, date_col)
    names = [f"lag_{i}" for i in range(1, lags + 1)]
    out = panel.withColumns({f"lag_{i}": F.lag(F.col(f"`{value_col}`"), i).over(w) for i in range(1, lags + 1)})
    return out.na.drop(subset=names) if complete else out


def first_difference(
    panel: DataFrame, keys: tuple[str, ...] = (), date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """Change against the previous row; the first row of a series goes."""
    v = F.col(f"`{value_col}`")
    return panel.withColumn("_change", v - F.lag(v).over(ordered(keys, date_col))).where(
        F.col("_change").isNotNull()
    ).withColumn(value_col, F.col("_change")).drop("_change")


def holdout_split(
    panel: DataFrame, keys: tuple[str, ...] = (), periods: int = 3, date_col: str = "Date",
) -> DataFrame:
    """``split`` = validation for the last ``periods`` rows of a series, train for the others."""
    back = F.row_number().over(ordered(keys, date_col, descending=True))
    return panel.withColumn("split", F.when(back <= periods, F.lit("validation")).otherwise(F.lit("train")))


def last_values(
    panel: DataFrame, keys: tuple[str, ...] = (), lags: int = 3, date_col: str = "Date", value_col: str = "Sales",
) -> DataFrame:
    """The newest ``lags`` rows of each series: ``recency`` 1 is the last."""
    back = F.row_number().over(ordered(keys, date_col, descending=True))
    return panel.withColumn("recency", back).where(F.col("recency") <= lags).select(
        *cols(keys), date_col, value_col, "recency"
    )


def top_rows(
    df: DataFrame, k: int, by: str = "Sales", keys: tuple[str, ...] = (), tie: tuple[str, ...] = ("Date",),
) -> DataFrame:
    """The k largest rows by a column, overall or per series; ties resolved by ``tie``."""
    order = [F.desc(F.col(f"`{by}`")), *cols(tie)]
    if not keys:
        return df.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(*cols(keys)).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
