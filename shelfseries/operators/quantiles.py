"""Exact quantiles of a column of any size, and the outlier fences built on them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIGNIFICANT_DIGITS = 4
SUB_BUCKETS = 10_000


def _magnitude_keys(v: Column) -> tuple[Column, Column]:
    """Two order-preserving keys: signed decimal magnitude, leading digits.

    At most 9,000 keys exist per decade, so a histogram over them stays small
    whatever the number of rows.
    """
    infinite = F.abs(v) == float("inf")
    safe = F.when(infinite | (v == 0), F.lit(1.0)).otherwise(v)
    exponent = F.greatest(F.floor(F.log10(F.abs(safe))), F.lit(-290))
    digits = F.floor(safe / F.pow(F.lit(10.0), exponent - (SIGNIFICANT_DIGITS - 1)))
    sign = F.signum(v).cast("long")
    major = F.when(infinite, sign * 10_000).when(v == 0, F.lit(0)).otherwise(sign * (exponent + 400))
    minor = F.when(infinite | (v == 0), F.lit(0)).otherwise(digits)
    return major.cast("long"), minor.cast("long")


def _brackets(histogram: DataFrame, order: list[str], partition: list[str], ranks: Column) -> list:
    """The histogram rows that hold one of the wanted ranks."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return (
        histogram.withColumn("upto", F.sum("n").over(w))
        .withColumn("before", F.col("upto") - F.col("n"))
        .withColumn("rank", F.explode(ranks))
        .where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
        .collect()
    )


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation between order statistics.

    Each pass groups the values into at most a few thousand ordered buckets per
    bracket, combined map-side, and keeps only the bucket that holds the wanted
    rank; it ends when that bucket holds one distinct value. Only bracket bounds
    reach the driver. Nulls and NaN are left out.
    """
    v = F.col(f"`{column}`").cast("double")
    values = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    major, minor = _magnitude_keys(F.col("v"))
    stats = [F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    first = (
        values.groupBy(major.alias("k1"), minor.alias("k2")).agg(*stats)
        .withColumn("total", F.sum("n").over(Window.partitionBy()))
    )
    spots = [F.lit(p) * (F.col("total") - 1) for p in probabilities]
    wanted = F.array_distinct(F.array(*[f(s).cast("long") for s in spots for f in (F.floor, F.ceil)]))
    rows = _brackets(first, ["k1", "k2"], [], wanted)
    if not rows:
        return [None] * len(probabilities)
    total = rows[0]["total"]
    found: dict[int, float] = {}
    while True:
        found.update({r["rank"]: r["lo"] for r in rows if r["lo"] == r["hi"]})
        open_rows = [r for r in rows if r["lo"] != r["hi"]]
        if not open_rows:
            break
        bounds = sorted({(r["lo"], r["hi"], r["before"]) for r in open_rows})
        inside = F.lit(None).cast("int")
        sub = F.lit(None).cast("long")
        ranks = F.array().cast("array<long>")
        for i, (lo, hi, before) in enumerate(bounds):
            hit = (F.col("v") >= lo) & (F.col("v") <= hi)
            inside = F.when(hit, F.lit(i)).otherwise(inside)
            cell = F.floor((F.col("v") - lo) / (hi - lo) * SUB_BUCKETS).cast("long")
            sub = F.when(hit, cell).otherwise(sub)
            local = [r["rank"] - before for r in open_rows if r["lo"] == lo]
            ranks = F.when(
                F.col("b") == i, F.array(*[F.lit(x).cast("long") for x in local])
            ).otherwise(ranks)
        finer = (
            values.select("v", inside.alias("b"), sub.alias("k")).where(F.col("b").isNotNull())
            .groupBy("b", "k").agg(*stats)
        )
        nested = _brackets(finer, ["k"], ["b"], ranks)
        rows = [
            {"lo": r["lo"], "hi": r["hi"], "before": bounds[r["b"]][2] + r["before"],
             "rank": bounds[r["b"]][2] + r["rank"]}
            for r in nested
        ]
    result = []
    for p in probabilities:
        spot = p * (total - 1)
        low = found[math.floor(spot)]
        high = found[math.ceil(spot)]
        result.append(low if low == high else low + (high - low) * (spot - math.floor(spot)))
    return result


def iqr_fences(df: DataFrame, column: str, factor: float = 1.5, method: str = "exact") -> tuple[float, float]:
    """Lower and upper fence ``q1 - f*iqr`` and ``q3 + f*iqr``.

    ``method="approx"`` takes the quartiles from Spark's quantile sketch in one
    pass (relative rank error 0.0001) for data where one more scan matters.
    """
    if method == "approx":
        quartiles = df.approxQuantile(column, [0.25, 0.75], 1e-4)
    else:
        quartiles = exact_quantiles(df, column, [0.25, 0.75])
    if not quartiles or quartiles[0] is None:
        return (-math.inf, math.inf)
    q1, q3 = quartiles
    return q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)


def clip(df: DataFrame, column: str, lower: float, upper: float) -> DataFrame:
    """Values held inside ``[lower, upper]``; null stays null."""
    c = F.col(f"`{column}`")
    return df.withColumn(column, F.when(c < lower, F.lit(lower)).when(c > upper, F.lit(upper)).otherwise(c))


def winsorize(df: DataFrame, column: str, factor: float = 1.5, method: str = "exact") -> DataFrame:
    """Cap a column at its IQR fences instead of dropping outliers."""
    lower, upper = iqr_fences(df, column, factor, method)
    return clip(df, column, lower, upper)
