"""Isolation forest over series of any length, as Spark jobs.

`anomaly.forest_scores` packs a series into one row, which the calendar bounds. Here a series may be all transactions: rows are
numbered, hashed row numbers deal a subsample to every tree, the trees grow side by side as small tables of cuts and path
lengths, and a series' trees merge into one step function of the value. Rows are scored in groups of bounded size
against it. No task sees a whole series.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import flag
from ..sources.staging import hold
from .anomaly import SAMPLE, SEED, TREES, _path_norm
from .windows import cols

#: Rows that are scored together at most, on average.
GROUP = 250_000
#: Candidates are drawn this much more often than trees need them, so that no tree runs short.
SPARE = 1.25


def _grow(values: np.ndarray, rng: np.random.Generator, limit: int) -> tuple[list[float], list[float]]:
    """Cuts of a random tree over sorted values, ascending, and the path length in each interval between them.

    A value equal to a cut belongs to the left.
    """
    cuts, depths = [], []

    def split(low: int, high: int, level: int) -> None:
        if high - low <= 1 or level == limit or values[low] == values[high - 1]:
            depths.append(level + float(_path_norm(high - low)))
            return
        cut = values[low] + rng.random() * (values[high - 1] - values[low])
        middle = int(np.searchsorted(values, cut, side="right"))
        split(low, middle, level + 1)
        cuts.append(float(cut))
        split(middle, high, level + 1)

    split(0, len(values), 0)
    return cuts, depths


def _tree(keys: tuple[str, ...], size: int, seed: int):
    limit = math.ceil(math.log2(max(size, 2)))

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        first = sample.iloc[0]
        rng = np.random.default_rng([seed, int(first["_series"]) & 0x7FFFFFFFFFFFFFFF, int(first["_tree"])])
        cuts, depths = _grow(np.sort(sample["_v"].to_numpy(dtype=float)), rng, limit)
        return pd.DataFrame([(*[first[k] for k in keys], first["_n"], cuts, depths)], columns=[*keys, "_n", "cuts", "depths"])
    return grow


def _merge(keys: tuple[str, ...], size: int):
    """All trees of a series as one step function: the raw score between the ascending cuts of all of them."""
    def merge(trees: pd.DataFrame) -> pd.DataFrame:
        cuts = np.concatenate([np.asarray(c, dtype=float) for c in trees["cuts"]])
        jumps = np.concatenate([np.diff(np.asarray(d, dtype=float)) for d in trees["depths"]])
        start = sum(d[0] for d in trees["depths"])
        order = np.argsort(cuts, kind="stable")
        mean = (start + np.concatenate([[0.0], np.cumsum(jumps[order])])) / len(trees)
        n = int(trees["_n"].iloc[0])
        raw = -np.exp2(-mean / max(float(_path_norm(min(size, n))), 1e-12))
        return pd.DataFrame([(*[trees[k].iloc[0] for k in keys], n, cuts[order], raw)], columns=[*keys, "n", "cuts", "raw"])
    return merge


def _with_key(df: DataFrame, other: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``df`` joined with the row of its series in ``other``; null keys are a series too."""
    named = other.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    if not keys:
        return df.crossJoin(F.broadcast(named))  # one row
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`")) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return df.join(named, condition).drop(*[f"_of_{k}" for k in keys])


def grow_forest(numbered: DataFrame, keys: tuple[str, ...], value: Column, trees: int = TREES, size: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """``(keys..., n, cuts, raw)`` per series of ``numbered`` (with ``_row``, a number of the row): the merged forest.

    A series of at least ``trees * size`` finite values deals the rows with its smallest hashes to the trees, so these share
    no row; a shorter one draws for every tree anew. Either way a tree has ``size`` rows, or all there are.
    """
    finite = numbered.select(*cols(keys), value.cast("double").alias("_v"), "_row").where("_v is not null and not isnan(_v) and abs(_v) < double('Infinity')")
    number = F.xxhash64(*cols(keys)) if keys else F.lit(0).cast("long")
    counts = hold(finite.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("_n")).withColumn("_series", number), "forest-counts")
    unit = F.shiftrightunsigned(F.xxhash64("_row", F.lit(seed)), 11) / F.lit(float(1 << 53))
    enough = trees * size
    drawn = _with_key(finite.withColumn("_u", unit), counts, keys).where(F.col("_u") < F.lit(SPARE * enough) / F.col("_n"))
    drawn = hold(drawn.drop("_row"), "forest-candidates")
    place = F.row_number().over(Window.partitionBy(*cols(keys)).orderBy("_u", "_v")) - 1  # SPARE * enough rows at most, about
    long_ = drawn.where(F.col("_n") >= enough).withColumn("_place", place).where(F.col("_place") < enough).withColumn("_tree", F.col("_place") % trees)
    every = drawn.where(F.col("_n") < enough).withColumn("_tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    own = F.row_number().over(Window.partitionBy(*cols(keys), "_tree").orderBy(F.xxhash64("_u", "_tree"), "_v"))
    short = every.withColumn("_place", own).where(F.col("_place") <= size)
    names = [*cols(keys), "_tree", "_v", "_n", "_series"]
    dealt = long_.select(*names).unionByName(short.select(*names))
    fields = "".join(f"`{k}` {numbered.schema[k].dataType.simpleString()}, " for k in keys)
    grown = dealt.groupBy(*cols(keys), "_tree").applyInPandas(_tree(keys, size, seed), f"{fields}_n long, cuts array<double>, depths array<double>")
    return grown.groupBy(*cols(keys)).applyInPandas(_merge(keys, size), f"{fields}n long, cuts array<double>, raw array<double>")


def _score(value_col: str):
    """Rows of one group with the raw score of their value; null where the value is no number or the series has no forest."""
    def score(rows: pa.Table, model: pa.Table) -> pa.Table:
        v = rows.column(value_col).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)
        raw = np.full(len(v), np.nan)
        known = np.isfinite(v)
        if model.num_rows:
            cuts, level = (np.asarray(model.column(c)[0].values.to_numpy(zero_copy_only=False), float) for c in ("cuts", "raw"))
            raw[known] = level[np.searchsorted(cuts, v[known], side="left")]
        column = pa.array(raw, mask=np.isnan(raw))
        return rows.drop_columns(["_salt"]).append_column("_raw", column)
    return score


def forest_scores(
    rows: DataFrame, keys: tuple[str, ...] = (), contamination: float = 0.03, value_col: str = "Sales", trees: int = TREES,
    size: int = SAMPLE, seed: int = SEED,
) -> DataFrame:
    """``rows`` with IForest_Score and Anomaly_IForest, as `anomaly.forest_scores` gives them, for series of any length.

    A row is a value; no date is needed, and rows may repeat. Null and infinite values take no part and get 0 and 0, as does
    a series without spread. Which rows a tree sees depends on ``seed`` and on how the table is stored, the distribution
    of the scores does not.
    """
    names = rows.columns
    numbered = hold(rows.withColumn("_row", F.monotonically_increasing_id()), "forest-rows")
    model = hold(grow_forest(numbered, keys, F.col(f"`{value_col}`"), trees, size, seed), "forest-model")
    groups = F.ceil(F.col("n") / GROUP).cast("int")
    sizes = model.select(*cols(keys), groups.alias("_groups"))
    if keys:
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`")) for k in keys]
        condition = same[0]
        for s in same[1:]:
            condition = condition & s
        placed = numbered.join(sizes.withColumnsRenamed({k: f"_of_{k}" for k in keys}), condition, "left")
    else:
        placed = numbered.join(F.broadcast(sizes), F.lit(True), "left")  # one row
    placed = placed.withColumn("_salt", F.pmod("_row", F.greatest(F.coalesce("_groups", F.lit(1)), F.lit(1))).cast("int"))
    placed = placed.select(*[F.col(f"`{c}`") for c in names], "_salt")
    copies = model.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(groups, F.lit(1)) - 1))).drop("n")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    scored = placed.groupBy(*cols(keys), "_salt").cogroup(copies.groupBy(*cols(keys), "_salt")).applyInArrow(_score(value_col), f"{schema}, _raw double")
    scored = hold(scored, "forest-scored")
    # a step function has few values, so its exact quantile needs few rows
    steps = scored.where("_raw is not null").groupBy(*cols(keys), "_raw").agg(F.count(F.lit(1)).alias("_times"))
    offset = steps.groupBy(*cols(keys)).agg(F.percentile("_raw", F.lit(float(contamination)), F.col("_times")).alias("_offset"))
    if not keys:
        offset = offset.agg(F.max("_offset").alias("_offset"))  # one row, also without values
    offset = hold(offset, "forest-offsets")
    done = _with_key(scored, offset, keys) if not keys else scored.join(
        offset.withColumnsRenamed({k: f"_of_{k}" for k in keys}), condition, "left")
    margin = F.col("_raw") - F.col("_offset")
    return done.select(*[F.col(f"`{c}`") for c in names], flag(F.coalesce(margin, F.lit(0.0)) < 0).alias("Anomaly_IForest"),
                       F.coalesce(margin, F.lit(0.0)).alias("IForest_Score"))
