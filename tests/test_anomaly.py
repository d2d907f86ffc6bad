import datetime

import numpy as np
import pytest

from shelfseries.operators import anomaly, kpi


def weekly(spark, values, key="a"):
    start = datetime.date(2015, 1, 5)
    rows = [(key, start + datetime.timedelta(weeks=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, Date date, Sales double")


@pytest.fixture(scope="module")
def values():
    out = np.random.default_rng(0).gamma(9, 1000, 209)
    out[[50, 120]] = 60000.0
    return out


@pytest.fixture(scope="module")
def flagged(spark, values):
    return anomaly.detect_anomalies(weekly(spark, values), ("key",)).persist()


def test_vote_and_share(flagged, values):
    out = flagged.orderBy("Date").toPandas()
    assert list(out.columns[3:]) == [
        "Z_Score", "Anomaly_Z", "Rolling_Mean", "Rolling_Std", "Anomaly_Rolling", "Anomaly_IForest", "IForest_Score",
        "Anomaly_Vote_Count", "Is_Anomaly"]
    votes = out.Anomaly_Z + out.Anomaly_Rolling + out.Anomaly_IForest
    assert (out.Anomaly_Vote_Count == votes).all() and (out.Is_Anomaly == (votes >= 2)).all()
    assert out.Anomaly_IForest.sum() == 7                       # 3 % of 209 weeks
    assert (out.Anomaly_IForest == (out.IForest_Score < 0)).all()
    assert np.percentile(out.IForest_Score, 3) == pytest.approx(0, abs=1e-12)
    assert out.Is_Anomaly[50] == 1 and out.Is_Anomaly[120] == 1
    assert anomaly.anomalies_only(flagged).count() == out.Is_Anomaly.sum()


def test_layout_and_order_do_not_matter(spark, flagged, values):
    shuffled = weekly(spark, values).repartition(7, "Sales")
    again = anomaly.detect_anomalies(shuffled, ("key",)).orderBy("Date").toPandas()
    assert np.array_equal(again.IForest_Score, flagged.orderBy("Date").toPandas().IForest_Score)


def test_extra_columns_come_back(spark, values):
    df = weekly(spark, values).selectExpr("key", "Date", "Sales", "'x' as note")
    out = anomaly.detect_anomalies(df, ("key",))
    assert out.where("note = 'x'").count() == len(values)


def test_settings_in_one_job_equal_single_runs(spark, values):
    df = weekly(spark, values)
    sets = [{"name": "default"}, {"name": "loose", "z_threshold": 1.5, "rolling_k": 1.5, "rolling_window": 12, "contamination": 0.1}]
    many = anomaly.detect_under_settings(df, sets, ("key",)).toPandas()
    for s in sets:
        args = {k: v for k, v in s.items() if k != "name"}
        single = anomaly.detect_anomalies(df, ("key",), **args).orderBy("Date").toPandas()
        part = many[many.setting == s["name"]].sort_values("Date").reset_index(drop=True)
        for c in ("Anomaly_Z", "Anomaly_Rolling", "Anomaly_IForest", "Is_Anomaly"):
            assert (part[c] == single[c]).all()
        assert np.allclose(part.Rolling_Std, single.Rolling_Std)


def test_series_longer_than_a_tree_sample(spark):
    values = np.random.default_rng(2).normal(100, 10, 700)
    values[[10, 600]] = [400, -300]
    out = anomaly.forest_scores(weekly(spark, values), ("key",), 0.01).orderBy("Date").toPandas()
    assert out.Anomaly_IForest.sum() == 7
    assert out.Anomaly_IForest[10] == 1 and out.Anomaly_IForest[600] == 1
    assert set(out.IForest_Score.nsmallest(2).index) == {10, 600}


def test_forest_depth_against_brute_force():
    """Expected isolation depth of each point, by drawing many plain trees."""
    y = np.array([1.0, 2.0, 3.0, 4.0, 20.0])
    rng = np.random.default_rng(1)

    def depth(points, x, level, limit):
        if len(points) <= 1 or level == limit or points.min() == points.max():
            return level + float(anomaly._path_norm(len(points)))
        cut = rng.uniform(points.min(), points.max())
        side = points <= cut
        return depth(points[side] if x <= cut else points[~side], x, level + 1, limit)

    plain = np.array([np.mean([depth(y, x, 0, 3) for _ in range(4000)]) for x in y])
    expected = -np.exp2(-plain / float(anomaly._path_norm(5)))
    got = np.mean([anomaly._isolation_scores(y, np.random.default_rng(s)) for s in range(60)], axis=0)
    assert got == pytest.approx(expected, abs=0.02)


def test_degenerate_series(spark):
    constant = anomaly.detect_anomalies(weekly(spark, [5.0] * 12), ("key",)).toPandas()
    assert constant.Is_Anomaly.sum() == 0 and (constant.IForest_Score == 0).all()
    single = anomaly.detect_anomalies(weekly(spark, [5.0]), ("key",)).toPandas()
    assert len(single) == 1 and single.Is_Anomaly[0] == 0
    broken = anomaly.forest_scores(weekly(spark, [1.0, float("nan"), 2.0]), ("key",)).toPandas()
    assert (broken.Anomaly_IForest == 0).all() and (broken.IForest_Score == 0).all()


def test_kpis_and_winsorizing(flagged):
    row = kpi.anomaly_kpis(flagged, ("key",)).first()
    assert row.max_spike == 60000.0 and row.forest_flags == 7
    assert row.anomaly_ratio == pytest.approx(row.anomalies / 209)
    none = kpi.anomaly_kpis(flagged.where("Is_Anomaly = 0")).first()
    assert none.anomalies == 0 and none.max_spike == 0.0
    capped = anomaly.winsorize_flagged(flagged).toPandas()
    hit = capped.Is_Anomaly == 1
    assert (capped.Sales_Winsorized[~hit] == capped.Sales[~hit]).all()
    assert (capped.Sales_Winsorized[hit] <= capped.Rolling_Mean[hit] + 2 * capped.Rolling_Std[hit] + 1e-9).all()
    assert anomaly.largest_anomalies(flagged, 1).first().Sales == 60000.0
