import datetime

import numpy as np
import pandas as pd
import pytest

from shelfseries.operators import clean, kmeans, segment
from shelfseries.plans import report


def transactions(spark, rows):
    schema = "`Order ID` string, `Order Date` date, `Product Name` string, Category string, Sales double"
    return clean.sales_features(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def facts():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        product = f"p{min(int(rng.exponential(4)), 14)}"            # one product holds much of the data
        day = datetime.date(2015, 1, 1) + datetime.timedelta(days=int(rng.integers(0, 1400)))
        rows.append((f"o{rng.integers(0, 200)}", day, product, rng.choice(["A", "B", None]), float(rng.gamma(2, 50))))
    # a product that skips years, and one with a single order
    rows += [("x1", datetime.date(2015, 3, 1), "gap", "A", 10.0), ("x2", datetime.date(2018, 3, 1), "gap", "A", 30.0),
             ("x3", datetime.date(2016, 3, 1), "once", None, 7.0)]
    return rows


def brute_force(rows):
    df = pd.DataFrame(rows, columns=["order", "date", "product", "category", "sales"])
    df["year"] = [d.year for d in df.date]
    df["ym"] = [(d.year, d.month) for d in df.date]
    out = pd.DataFrame({"total": df.groupby("product").sales.sum()})
    yearly = df.pivot_table(index="product", columns="year", values="sales", aggfunc="sum").fillna(0.0)
    steps = [(yearly[b] - yearly[a]) / (yearly[a] + 1.0) for a, b in zip(yearly.columns, yearly.columns[1:])]
    out["growth"] = sum(steps) / len(steps)
    monthly = df.groupby(["product", "ym"]).sales.sum().unstack(fill_value=0.0)
    out["volatility"] = monthly.std(axis=1)
    out["aov"] = out.total / (df.groupby("product").order.nunique() + 1e-5)
    mode = df.groupby("product").category.agg(lambda s: s.mode().iloc[0] if not s.mode().empty else "Unknown")
    return out, mode


def test_features_against_brute_force(spark, facts):
    got = segment.product_features(transactions(spark, facts)).toPandas().set_index("Product Name").sort_index()
    want, mode = brute_force(facts)
    want = want.sort_index()
    for ours, theirs in zip(segment.FEATURES, ["total", "growth", "volatility", "aov"]):
        assert got[ours].to_numpy() == pytest.approx(want[theirs].to_numpy(), rel=1e-9, abs=1e-9)
    assert (got.Category == mode.sort_index()).all()
    assert got.loc["once", "Category"] == "Unknown"


def test_feature_fallbacks(spark):
    df = spark.createDataFrame([("A", 2.0), ("A", 4.0), ("B", 1.0)], "Category string, Sales double")
    got = segment.product_features(df).toPandas().set_index("Category")
    assert got.loc["A", "Total_Sales"] == 6.0 and got.loc["A", "Avg_Order_Value"] == pytest.approx(6 / 2.00001)
    assert (got.YoY_Growth == 0).all() and (got.Monthly_Sales_Volatility == 0).all()


def test_scaling_uses_population_deviation(spark, facts):
    scaled = segment.scale_features(segment.product_features(transactions(spark, facts))).toPandas()
    for f in segment.FEATURES:
        assert scaled[f"z_{f}"].mean() == pytest.approx(0, abs=1e-9)
        assert scaled[f"z_{f}"].std(ddof=0) == pytest.approx(1)


def blobs(spark, sizes=(700, 40, 40, 40)):
    rng = np.random.default_rng(1)
    centres = np.array([[0, 0, 0, 0], [8, 0, 0, 0], [0, 8, 0, 0], [0, 0, 8, 8]], dtype=float)
    x = np.vstack([c + rng.normal(0, 0.3, (n, 4)) for c, n in zip(centres, sizes)])
    return x, spark.createDataFrame(pd.DataFrame(x, columns=segment.SCALED)), centres


def test_kmeans_finds_separated_groups_of_uneven_size(spark):
    x, df, centres = blobs(spark)
    found, cost = kmeans.fit_many(df, segment.SCALED, [4], 5, 42)[4]
    for c in centres:
        assert np.min(np.linalg.norm(found - c, axis=1)) < 0.3
    own = np.argmin(((x[:, None, :] - found[None]) ** 2).sum(axis=2), axis=1)
    assert cost == pytest.approx(((x - found[own]) ** 2).sum())
    labels = df.withColumn("c", kmeans.nearest_centre(segment.SCALED, found)).toPandas()
    assert (labels.c.to_numpy() == np.argmin(((labels[segment.SCALED].to_numpy()[:, None, :] - found[None]) ** 2).sum(axis=2), axis=1)).all()


def test_seeds_reach_small_groups_of_a_large_table(spark):
    """A group of 12 rows among 60,000 is too small for any uniform sample of a few thousand rows."""
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(0, 1, (60_000, 2)), rng.normal(0, 0.01, (12, 2)) + [60, 60], rng.normal(0, 0.01, (12, 2)) + [-60, 60]])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"])).repartition(6)
    pools = kmeans._candidates(df, ["a", "b"], 3, 2, 42)
    for rows, weight in pools:
        assert weight.sum() == len(x) and len(rows) <= (kmeans.ROUNDS + 1) * kmeans.OVERSAMPLE * 3
        assert (rows[:, 0] > 50).any() and (rows[:, 0] < -50).any()
    found, _ = kmeans.fit_many(df, ["a", "b"], [3], 2, 42)[3]
    assert sorted(np.round(found[:, 0]).tolist()) == [-60, 0, 60]


def test_seeds_do_not_depend_on_the_layout(spark):
    x, df, _ = blobs(spark)
    one, many = (kmeans._candidates(t, segment.SCALED, 4, 2, 42) for t in (df.coalesce(1), df.repartition(7)))
    for (a, n), (b, m) in zip(one, many):
        assert np.array_equal(a, b) and np.array_equal(n, m)


def test_scaling_works_out_the_features_once(spark, facts):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    features = segment.product_features(transactions(spark, facts))
    rows = features.count()
    scaled = segment.scale_features(features.mapInPandas(counted, features.schema))
    assert len(scaled.collect()) == rows and seen.value == rows


def test_few_distinct_points(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 5 + [(2.0, 2.0)], "a double, b double")
    found, cost = kmeans.fit_many(df, ["a", "b"], [1, 4], 2, 42)[4]
    assert len(found) == 2 and cost == pytest.approx(0)
    with pytest.raises(ValueError):
        kmeans.fit_many(df.limit(0), ["a", "b"], [2], 1, 42)


def test_elbow(spark):
    x, df, _ = blobs(spark)
    table = segment.elbow(df, 6, 5).toPandas().set_index("k").Inertia
    assert table[1] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
    assert (np.diff(table.sort_index()) <= 1e-6).all()
    assert table[4] < 0.2 * table[3]


def test_labels_and_ties(spark):
    rows = [(0, 100.0, 0.5), (1, 1.0, 0.1), (2, 20.0, 0.3), (3, 10.0, 0.3)]
    df = spark.createDataFrame(rows, "Cluster int, Total_Sales double, YoY_Growth double")
    got = {r.Cluster: r.ClusterLabel for r in segment.label_clusters(df).collect()}
    assert got == {0: segment.HIGH, 1: segment.LOW, 2: segment.GROWING, 3: segment.DECLINING}   # tie: higher sales grows
    faster = df.withColumn("YoY_Growth", df.YoY_Growth + (df.Cluster == 3).cast("double"))
    got = {r.Cluster: r.ClusterLabel for r in segment.label_clusters(faster).collect()}
    assert got[3] == segment.GROWING and got[2] == segment.DECLINING


def test_segments_projection_and_report(spark, facts):
    scaled = segment.scale_features(segment.product_features(transactions(spark, facts)))
    segmented = segment.segment(scaled, starts=4).persist()
    assert segmented.count() == scaled.count()
    assert {r.ClusterLabel for r in segmented.select("ClusterLabel").distinct().collect()} == {
        segment.HIGH, segment.LOW, segment.GROWING, segment.DECLINING}
    points = segment.project(segmented, "Product Name").toPandas()
    z = segmented.select(*segment.SCALED).toPandas().to_numpy()
    values = np.linalg.eigvalsh(np.cov(z.T, ddof=0))[::-1]
    assert points.PCA1.var(ddof=0) == pytest.approx(values[0]) and points.PCA2.var(ddof=0) == pytest.approx(values[1])
    # a stored table has no scaled columns: they are rebuilt
    stored = segment.project(segmented.drop(*segment.SCALED), "Product Name").toPandas()
    assert np.allclose(stored.sort_values("Product Name").PCA1, points.sort_values("Product Name").PCA1)
    table = report.segment_table(segmented).collect()
    assert len(table) == 4 and all(r["Core Strategy"] for r in table)
    assert segment.cluster_profile(segmented).count() == 4
    assert segment.members(segmented, segment.HIGH, "Product Name").count() >= 1
    with pytest.raises(ValueError):
        segment.segment(scaled, k=5)
