import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfseries.operators import anomaly, forest
from tests.test_anomaly import weekly


def test_agrees_with_the_packed_kernel(spark):
    values = np.random.default_rng(0).gamma(9, 1000, 209)
    values[[50, 120]] = 60000.0
    panel = weekly(spark, values)
    packed = anomaly.forest_scores(panel, ("key",)).orderBy("Date").toPandas()
    spread = forest.forest_scores(panel, ("key",)).orderBy("Date").toPandas()
    assert np.corrcoef(packed.IForest_Score, spread.IForest_Score)[0, 1] > 0.97
    assert spread.Anomaly_IForest.sum() == 7 and (spread.Anomaly_IForest == (spread.IForest_Score < 0)).all()
    assert spread.Anomaly_IForest[50] == 1 and spread.Anomaly_IForest[120] == 1
    alone = forest.forest_scores(panel).orderBy("Date").toPandas()
    assert np.corrcoef(packed.IForest_Score, alone.IForest_Score)[0, 1] > 0.97


def test_tree_is_a_step_function():
    values = np.sort(np.random.default_rng(1).normal(size=64))
    cuts, depths = forest._grow(values, np.random.default_rng(2), 6)
    assert len(depths) == len(cuts) + 1 and cuts == sorted(cuts)
    place = np.searchsorted(cuts, values, side="left")
    counts = np.bincount(place, minlength=len(depths))
    assert (counts > 0).all() and max(depths) <= 6 + float(anomaly._path_norm(64))
    for k, n in enumerate(counts):
        assert n == 1 or depths[k] == pytest.approx(6 + float(anomaly._path_norm(n)))


def test_merged_forest_is_the_mean_of_its_trees():
    rng = np.random.default_rng(3)
    trees = [forest._grow(np.sort(rng.normal(size=32)), rng, 5) for _ in range(7)]
    table = pd.DataFrame([(32, c, d) for c, d in trees], columns=["_n", "cuts", "depths"])
    one = forest._merge((), 32)(table).iloc[0]
    x = np.concatenate([rng.normal(size=200), np.concatenate([c for c, _ in trees])])
    mean = np.mean([np.asarray(d)[np.searchsorted(c, x, side="left")] for c, d in trees], axis=0)
    want = -np.exp2(-mean / float(anomaly._path_norm(32)))
    assert one["raw"][np.searchsorted(one["cuts"], x, side="left")] == pytest.approx(want)


def test_long_series_without_keys(spark, monkeypatch):
    """Trees share no row, groups stay bounded, and the rarest values are found."""
    monkeypatch.setattr(forest, "GROUP", 10_000)
    n = 120_000
    rows = spark.range(n, numPartitions=6).select(
        "id", F.when(F.col("id") == 77, 1e6).when(F.col("id") == 99_999, -1e6).otherwise(F.randn(5) * 10).alias("Sales"))
    out = forest.forest_scores(rows, contamination=0.01).toPandas()
    assert len(out) == n and 0 < out.Anomaly_IForest.sum() <= 0.01 * n + 1
    # what lies beyond the sampled values shares the outermost path length
    assert {77, 99_999} <= set(out[out.Anomaly_IForest == 1].id)
    # far from the middle means easier to isolate
    middle, edge = out[out.Sales.abs() < 5].IForest_Score.mean(), out[out.Sales.abs() > 25].IForest_Score.mean()
    assert edge < middle


def test_hot_series_and_odd_values(spark):
    rows = [("hot", float(v)) for v in np.random.default_rng(0).normal(0, 1, 30_000)] + [(None, 1.0), (None, 2.0), (None, 50.0), ("same", 3.0), ("same", 3.0),
            ("one", 4.0), ("broken", None), ("broken", float("nan")), ("hot", None), ("hot", float("inf"))]
    df = spark.createDataFrame(rows, "key string, Sales double").withColumns({"n": F.lit(1), "cuts": F.lit("x")})
    out = forest.forest_scores(df, ("key",)).toPandas()
    assert list(out.columns) == ["key", "Sales", "n", "cuts", "Anomaly_IForest", "IForest_Score"] and len(out) == len(rows)
    hot = out[(out.key == "hot") & np.isfinite(out.Sales)]
    assert 0 < hot.Anomaly_IForest.sum() <= 0.03 * 30_000 + 1
    rest = out[out.key.isin(["same", "one", "broken"]) | ~np.isfinite(out.Sales)]
    assert (rest.Anomaly_IForest == 0).all() and (rest.IForest_Score == 0).all()
    assert out[out.key.isna()].set_index("Sales").Anomaly_IForest[50.0] == 1
    assert forest.forest_scores(df.limit(0), ("key",)).count() == 0 and forest.forest_scores(df.limit(0)).count() == 0
