import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfseries.operators import rollup, tsstats, windows
from shelfseries.plans import star
from tests import golden

D = datetime.date


def lines(spark, rows):
    return spark.createDataFrame([(k, d, float(v)) for k, d, v in rows], "k string, `Order Date` date, Sales double")


def series(spark, values, keys=None):
    rows = list(zip(golden.months((2015, 1), len(values)), map(float, values)))
    return spark.createDataFrame(rows, "Date date, Sales double")


def test_week_closes_on_monday(spark):
    df = lines(spark, [("a", D(2018, 12, 30), 1), ("a", D(2018, 12, 31), 2), ("a", D(2019, 1, 1), 4)])
    out = {r.Date: r.Sales for r in rollup.weekly(df).collect()}
    assert out == {D(2018, 12, 31): 3.0, D(2019, 1, 7): 4.0}    # Sunday and Monday together, Tuesday opens a week


@pytest.mark.parametrize("period,gap", [("day", 3), ("week", 2), ("month", 4)])
def test_gaps_are_zero(spark, period, gap):
    start = D(2018, 1, 1)
    later = {"day": D(2018, 1, 5), "week": D(2018, 1, 22), "month": D(2018, 6, 3)}[period]
    out = rollup.roll_up(lines(spark, [("a", start, 1), ("a", later, 2)]), period).orderBy("Date").collect()
    assert len(out) == gap + 2
    assert [r.Sales for r in out] == [1.0] + [0.0] * gap + [2.0]


def test_global_span_extends_every_series(spark):
    df = lines(spark, [("a", D(2018, 1, 3), 1), ("b", D(2018, 4, 1), 2), ("a", D(2018, 2, 1), 5)])
    out = rollup.monthly(df, ("k",), span="global").toPandas()
    assert out.groupby("k").size().to_dict() == {"a": 4, "b": 4}
    assert out.Sales.sum() == 8.0
    assert rollup.monthly(df, ("k",)).groupBy("k").count().toPandas().set_index("k")["count"].to_dict() == {"a": 2, "b": 1}


def test_rollups_conserve_totals_and_have_no_gaps(spark, small):
    df = star.sales(spark, small, "Order Date", "Region", "Sales")
    total = df.agg(F.sum("Sales")).first()[0]
    steps = {"day": 1, "week": 7}
    for period in ("day", "week", "month"):
        out = rollup.roll_up(df, period, ("Region",)).toPandas()
        assert out.Sales.sum() == pytest.approx(total)
        for _, part in out.groupby("Region"):
            days = pd.to_datetime(part.Date).sort_values().diff().dropna().dt.days
            assert days.between(28, 31).all() if period == "month" else (days == steps[period]).all()


def test_stacked_dimensions_count_every_line_once_per_dimension(spark, small):
    df = star.sales(spark, small, "Order Date", "Category", "Region", "Sales")
    out = rollup.stack_dimensions(df, ["Category", "Region"]).groupBy("dimension").agg(F.sum("Sales").alias("s")).collect()
    total = df.agg(F.sum("Sales")).first()[0]
    assert {r.dimension: pytest.approx(total) for r in out} == {r.dimension: r.s for r in out}
    assert len(out) == 2


@pytest.mark.parametrize("n,window", [(1, 8), (2, 8), (5, 8), (13, 8), (40, 8), (40, 2), (40, 24), (90, 24)])
def test_centred_bands_against_pandas(spark, n, window):
    values = np.random.default_rng(n).gamma(2, 100, n)
    size = max(3, min(window, n // 3))
    rolling = pd.Series(values).rolling(size, min_periods=1, center=True)
    out = windows.centred_bands(series(spark, values), (), window).orderBy("Date").toPandas()
    assert out.Rolling_Mean.to_numpy() == pytest.approx(rolling.mean().to_numpy())
    assert out.Rolling_Std.to_numpy() == pytest.approx(rolling.std().fillna(0.0).to_numpy(), abs=1e-9)


def test_centred_bands_of_any_size_are_one_frame(spark):
    lengths = [*range(1, 60, 4), 400]                            # sizes from 3 to 133 in one panel
    rows = [(f"s{n}", d, float(v)) for n in lengths
            for d, v in zip(golden.months((1985, 1), n), np.random.default_rng(n).gamma(2, 100, n))]
    panel = spark.createDataFrame(rows, "k string, Date date, Sales double")
    out = windows.centred_bands(panel, ("k",), 500)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RangeFrame, -") == 2                      # the mean and the deviation
    for name, part in out.toPandas().groupby("k"):
        part = part.sort_values("Date")
        rolling = part.Sales.rolling(max(3, len(part) // 3), min_periods=1, center=True)
        assert part.Rolling_Mean.to_numpy() == pytest.approx(rolling.mean().to_numpy()), name
        assert part.Rolling_Std.to_numpy() == pytest.approx(rolling.std().fillna(0.0).to_numpy(), abs=1e-9), name
    with pytest.raises(ValueError, match="at most"):
        windows.centred_bands(panel, ("k",), windows.MOST_BAND + 1)


def test_thresholds_are_strict(spark):
    constant = windows.z_scores(series(spark, [5.0] * 10)).toPandas()
    assert (constant.Z_Score == 0).all() and (constant.Anomaly_Z == 0).all()
    flat = windows.centred_bands(series(spark, [5.0] * 10)).toPandas()
    assert (flat.Anomaly_Rolling == 0).all()                     # on the bound, not outside
    spread = windows.z_scores(series(spark, [0.0, 2.0]), threshold=2 ** -0.5).toPandas()
    assert (spread.Anomaly_Z == 0).all()


def test_repeated_date_fails(spark):
    df = spark.createDataFrame([(D(2018, 1, 1), 1.0), (D(2018, 1, 1), 2.0)], "Date date, Sales double")
    with pytest.raises(Exception, match="two rows for one date"):
        windows.per_period(df, (), "Date", "Sales").collect()
    with pytest.raises(Exception, match="two rows for one date"):
        tsstats.dickey_fuller(df).collect()


def test_trailing_mean_difference_lags_and_split(spark):
    df = series(spark, [1, 2, 4, 8])
    out = windows.trailing_mean(df).orderBy("Date").toPandas()
    assert list(out.Rolling_3M) == pytest.approx([1, 1.5, 7 / 3, 14 / 3])
    assert [r.Sales for r in windows.first_difference(df).orderBy("Date").collect()] == [1, 2, 4]
    lag = windows.lagged(df).collect()
    assert [(r.Sales, r.lag_1, r.lag_2, r.lag_3) for r in lag] == [(8, 4, 2, 1)]
    split = windows.holdout_split(df, (), 3).orderBy("Date").collect()
    assert [r.split for r in split] == ["train"] + ["validation"] * 3
    assert {r.recency: r.Sales for r in windows.last_values(df, (), 2).collect()} == {1: 8, 2: 4}


def test_published_decomposition_and_autocorrelation(spark):
    df = series(spark, golden.MONTHLY)
    out = tsstats.decompose(df).orderBy("Date").toPandas()
    trend = out.trend.dropna()
    assert len(trend) == 36
    assert (trend.iloc[0], trend.iloc[-1]) == pytest.approx(golden.TREND_ENDS, abs=1e-3)
    assert list(out.seasonal[:12]) == pytest.approx(golden.SEASONAL, abs=0.06)
    assert np.allclose((out.trend + out.seasonal + out.resid - out.Sales).dropna(), 0)
    acf = {r.lag: r.acf for r in tsstats.autocorrelation(df).collect()}
    assert acf[0] == 1.0
    assert {k: acf[k] for k in golden.ACF} == pytest.approx(golden.ACF, abs=5e-5)


def test_partial_autocorrelation_against_toeplitz_solution(spark):
    df = series(spark, golden.MONTHLY)
    acf = [r.acf for r in tsstats.autocorrelation(df).orderBy("lag").collect()]
    pacf = [r.pacf for r in tsstats.partial_autocorrelation(df).orderBy("lag").collect()]
    assert pacf[0] == 1.0
    for k in range(1, 16):
        matrix = np.array([[acf[abs(i - j)] for j in range(k)] for i in range(k)])
        assert pacf[k] == pytest.approx(np.linalg.solve(matrix, acf[1:k + 1])[-1], abs=1e-9)


def test_dickey_fuller(spark):
    out = {r.transform: r for r in tsstats.dickey_fuller(series(spark, golden.MONTHLY)).collect()}
    assert round(out["level"].p_value, 4) == golden.ADF_P_VALUE
    assert out["level"].stationary and out["level"].error is None
    rng = np.random.default_rng(0)
    walk = tsstats.dickey_fuller(series(spark, np.cumsum(rng.normal(size=200)))).where("transform = 'level'").first()
    assert not walk.stationary
    noise = tsstats.dickey_fuller(series(spark, rng.normal(size=200))).where("transform = 'level'").first()
    assert noise.stationary and noise.p_value < 1e-6
    short = tsstats.dickey_fuller(series(spark, [1.0])).collect()
    assert all(r.error for r in short)


def test_panel_result_does_not_depend_on_layout(spark, small):
    df = rollup.monthly(star.sales(spark, small, "Order Date", "Region", "Sales"), ("Region",))
    one = tsstats.decompose(df.coalesce(1), ("Region",)).toPandas()
    many = tsstats.decompose(df.repartition(5, "Date"), ("Region",)).toPandas()
    order = ["Region", "Date"]
    left, right = (x.sort_values(order).reset_index(drop=True) for x in (one, many))
    assert np.allclose(left.seasonal, right.seasonal)
