"""Every query with reference SQL gives the same rows; the others give rows."""

import pytest

import __spark_entry__ as entry_points
from shelfseries.catalog import QUERIES, SQL, modelling
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_reference_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["Region", "Date", "Sales", "Rolling_3M"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, duck, name):
    assert differences(QUERIES[name](spark, small), duck, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"forecast_pooled_boosting"}))
def test_has_rows(spark, small, name, monkeypatch):
    monkeypatch.setattr(modelling, "STARTS", 2)
    rows = [r.asDict() for r in QUERIES[name](spark, small).collect()]  # a count would leave columns uncomputed
    assert rows
    for r in rows:
        if r.get("Forecast") is not None and r.get("Lower_CI") is not None:
            assert 0 <= r["Lower_CI"] <= r["Forecast"] + 1e-9 and r["Forecast"] <= r["Upper_CI"] + 1e-9
        if "Is_Anomaly" in r:
            votes = r["Anomaly_Z"] + r["Anomaly_Rolling"] + r["Anomaly_IForest"]
            assert r["Is_Anomaly"] == (votes >= 2)
        for error in ("MAE", "RMSE", "MAPE", "Inertia"):
            assert not isinstance(r.get(error), float) or r[error] >= 0


def test_headline_values(spark, small):
    """The one row agrees with the queries that it sums up."""
    (row,) = QUERIES["report_headline"](spark, small).collect()
    first = QUERIES["whole_business_comparison"](spark, small).first()
    assert (row.best_model, row.best_mape) == (first.Model, pytest.approx(first.MAPE))
    assert row.anomalies == len(QUERIES["whole_business_anomalies"](spark, small).collect())
