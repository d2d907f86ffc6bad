"""The whole batch job on a text export, and what the plans look like."""

import pytest
from pyspark.sql import functions as F

from shelfseries.catalog.cleaning import text_export
from shelfseries.forecast import models
from shelfseries.operators import clean, kpi, rollup, segment
from shelfseries.plans import dashboard, jobs, report, star
from shelfseries.sources import files, staging


@pytest.fixture(scope="module")
def outputs(spark, small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    source = text_export(spark, small)
    parts = star.sales(spark, small, "Row ID", "Product Name", "Sub-Category").dropDuplicates(["Row ID"])
    source = source.join(parts, "Row ID")
    files.save(source, str(folder / "export"), fmt="csv")
    raw = files.load_sales(spark, str(folder / "export"))
    return jobs.run_all(raw, str(folder / "out"), starts=2), str(folder / "out"), raw


def test_all_tables_exist_and_agree(spark, outputs):
    out, folder, raw = outputs
    facts = out["train_clean"]
    total = facts.agg(F.sum("Sales")).first()[0]
    for name in ("daily_sales", "weekly_sales", "monthly_sales"):
        assert files.load_table(spark, f"{folder}/{name}").agg(F.sum("Sales")).first()[0] == pytest.approx(total)
    assert facts.count() < raw.count()
    assert out["model_comparison"].count() == 3
    assert out["forecast_future"].count() == 3
    assert out["anomalies_only"].count() == out["weekly_sales_anomalies"].where("Is_Anomaly = 1").count()
    assert out["segmented_products"].count() == facts.select("Product Name").distinct().count()
    assert out["elbow"].count() == 8
    assert out["report_segments"].columns == ["Demand Segment", "Product Count", "Core Strategy"]
    assert models.load_best(spark, f"{folder}/best_forecast", 6).count() == 6
    assert set(files.load_table(spark, f"{folder}/train_clean").columns) == set(facts.columns)


def test_headline(outputs):
    out, _, _ = outputs
    best = models.best_models(out["model_comparison"])
    row = report.headline(best, out["weekly_sales_anomalies"], out["train_clean"]).first()
    assert row.best_model in models.COMPARED and row.line_count == out["train_clean"].count()


def test_weekly_chain_and_segments_write_their_tables(spark, outputs, tmp_path):
    facts = outputs[0]["train_clean"]
    flagged = jobs.weekly_anomalies(facts, str(tmp_path))
    assert files.load_table(spark, f"{tmp_path}/anomalies_only").count() == flagged.where("Is_Anomaly = 1").count()


def test_dashboard(spark, small):
    df = clean.sales_features(star.sales(spark, small))
    tables = dashboard.sales_dashboard(df, region="ASIA")
    whole = df.where("Region = 'ASIA'").agg(F.sum("Sales")).first()[0]
    assert tables["kpis"].first().total_sales == pytest.approx(whole)
    assert tables["monthly_trend"].agg(F.sum("Sales")).first()[0] == pytest.approx(whole)
    assert tables["regions"].count() == 5 and tables["region_sales"].count() == 1
    assert tables["heatmap"].columns[1:] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def test_export_and_partitioned_write(spark, tmp_path):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "step int, Forecast double")
    files.export_forecast(df, str(tmp_path / "f.csv"), 2)
    assert files.load_table(spark, str(tmp_path / "f.csv")).count() == 2


def test_staging(spark):
    held = staging.hold(spark.range(5).withColumnRenamed("id", "a b"), "numbers")
    assert sorted(r["a b"] for r in held.collect()) == [0, 1, 2, 3, 4]
    text = held._jdf.queryExecution().toString()
    if staging.shared_folder(held):
        assert "Range" not in text and staging.shared_folder(held) in held.inputFiles()[0]
    else:
        assert "InMemoryRelation" in text


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unneeded_tables_are_not_joined(spark, small):
    text = plan(rollup.monthly(star.sales(spark, small, "Order Date", "Sales")))
    assert "customer" not in text and "part.parquet" not in text
    assert "CartesianProduct" not in text


def test_columns_are_pruned_at_the_scan(spark, small):
    text = kpi.sales_by(star.sales(spark, small, "Region", "Sales"), "Region")._jdf.queryExecution().toString()
    assert "l_quantity" not in text.split("Physical Plan")[1]


def test_sums_are_combined_before_the_shuffle(spark, small):
    text = plan(rollup.monthly(star.sales(spark, small, "Order Date", "Region", "Sales"), ("Region",)))
    assert "partial_sum" in text


def test_features_have_no_cross_product_of_products_and_calendar(spark, small):
    lines = star.sales(spark, small, "Order ID", "Order Date", "Product Name", "Category", "Sales")
    text = plan(segment.product_features(clean.sales_features(lines)))
    assert "CartesianProduct" not in text
