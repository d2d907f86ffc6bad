import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfseries.errors import DataValidationError
from shelfseries.functions import numeric as num
from shelfseries.operators import clean, quality, quantiles
from shelfseries.plans import jobs
from shelfseries.sources import files

RAW = "`Order Date` string, `Ship Date` string, Region string, Sales string, Profit string"


def raw(spark, rows, schema=RAW):
    return spark.createDataFrame(rows, schema)


def test_clean_sales_small_frame(spark):
    df = raw(spark, [
        ("31/12/2018", "2019-01-02", "  West ", "10.5", "1.05"),
        ("31/12/2018", "2019-01-02", "  West ", "10.5", "1.05"),   # exact duplicate
        ("2018-12-31", None, "West", "-3", "x"),                    # negative, not shipped, bad profit
        ("12/31/2018", "bad", None, "7", None),                     # month first, bad ship date
        ("bad", "2019-01-01", "East", "5", "1"),
        (None, None, "East", "5", "1"),
        ("2018-12-31", "2018-12-30", "East", "x", "1"),
        ("2018-12-31", "2018-12-30", "East", None, "1"),
    ]).toDF(" Order Date ", "Ship Date", "Region", "Sales", "Profit")
    out = clean.sales_features(clean.clean_sales(df)).toPandas()
    assert len(out) == 3
    assert set(out["Order Date"]) == {datetime.date(2018, 12, 31)}
    assert sorted(out["Sales"]) == [0.0, 7.0, 10.5]
    by_sales = out.set_index("Sales")
    assert by_sales.loc[10.5, "Region"] == "West"
    assert by_sales.loc[10.5, "ShippingDays"] == 2
    assert np.isnan(by_sales.loc[0.0, "ShippingDays"])          # not shipped stays null, not 0
    assert by_sales.loc[7.0, "Region"] is None                  # a null label stays null
    assert by_sales.loc[10.5, "ProfitMargin"] == pytest.approx(0.1)
    assert np.isnan(by_sales.loc[0.0, "ProfitMargin"])          # no sales, no margin
    row = by_sales.loc[10.5]
    assert (row["Year"], row["Month"], row["MonthName"], row["Quarter"], row["Day"]) == (2018, 12, "Dec", 4, 31)
    assert (row["DayOfWeek"], row["DayName"], row["WeekOfYear"], row["IsWeekend"]) == (0, "Mon", 1, False)
    assert row["YearMonth"] == "2018-12"


def test_day_first_wins_over_month_first(spark):
    df = raw(spark, [("03/04/2018", None, None, "1", None)])
    assert df.select(clean.parse_date(df, "Order Date").alias("d")).first().d == datetime.date(2018, 4, 3)


def test_clean_titles_small_frame(spark):
    df = spark.createDataFrame(
        [("A", " PS2 ", "1999", "1.5", None, "3"), ("B", None, "1969", "1", "1", "1"), ("C", "Wii", "n/a", "1", "1", "1"),
         ("D", None, "2006.0", "-2", "x", "0"), ("E", "PC", "2031", "1", "1", "1")],
        "Name string, Platform string, Year string, NA_Sales string, EU_Sales string, Global_Sales string")
    df = df.withColumns({"JP_Sales": F.lit("0.5"), "Other_Sales": F.lit("0.5")})
    out = clean.title_features(clean.clean_titles(df, last_year=2030)).toPandas().set_index("Name")
    assert list(out.index.sort_values()) == ["A", "D"]
    assert out.loc["A", "Platform"] == "PS2" and out.loc["D", "Platform"] == "Unknown"
    assert out.loc["A", "NA_Share"] == 0.5 and out.loc["A", "EU_Share"] == 0.0
    assert out.loc["D", "NA_Share"] == 0.0                      # no global sales
    assert out.loc["A", "Decade"] == "1990s" and out.loc["A", "ReleaseDate"] == datetime.date(1999, 1, 1)


def test_required_columns_and_rows(spark):
    with pytest.raises(DataValidationError, match="Order Date"):
        quality.require_columns(spark.createDataFrame([(1,)], "Sales int"), ["Order Date", "Sales"])
    with pytest.raises(DataValidationError, match="no rows"):
        quality.require_rows(spark.createDataFrame([], "Sales int"))


def test_missingness(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, None, "y"), (3, 4, "z")], "a int, b int, c string")
    assert [tuple(r) for r in quality.missingness(df).collect()] == [("a", 2, 66.67), ("b", 1, 33.33)]


def test_cleaning_counts_include_capped(spark):
    df = raw(spark, [("2018-01-01", None, None, s, None) for s in ("1", "-2", "x", "500")])
    row = quality.cleaning_counts(df, clean.parse_date(df, "Ship Date"), clean.to_number("Sales"), 0.0, 100.0).first()
    assert (row.row_count, row.bad_dates, row.bad_numbers, row.negatives, row.capped) == (4, 4, 1, 1, 2)


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [0.0] * 50 + [1e6], list(range(1000)),
    [-(10.0 ** k) for k in range(-5, 6)] + [0.0] + [10.0 ** k for k in range(-5, 6)],
    [999.95, 999.9999999999999, 1000.0, 1000.05, 99.99],
    list(np.round(np.random.default_rng(3).lognormal(5, 3, 4000), 2)),
    list(np.random.default_rng(4).normal(0, 1e-3, 3001) + 1e6),
])
def test_exact_quantiles_against_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, "x", probabilities)
    assert got == pytest.approx(list(np.quantile(np.array(values, dtype=float), probabilities)), rel=1e-12, abs=1e-12)


def test_quantiles_skip_nulls_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert quantiles.exact_quantiles(df, "x", [0.5]) == [2.0]
    assert quantiles.exact_quantiles(df.where("x < 0"), "x", [0.5]) == [None]


def test_winsorize_caps_and_keeps_rows(spark):
    values = [float(v) for v in range(1, 101)] + [1e5, -1e5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    q1, q3 = np.quantile(values, [0.25, 0.75])
    out = [r.x for r in quantiles.winsorize(df, "x", 1.5).collect()]
    expected = np.clip(values, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert sorted(out) == pytest.approx(sorted(expected))
    approx = quantiles.iqr_fences(df, "x", 1.5, method="approx")
    assert approx == pytest.approx(quantiles.iqr_fences(df, "x", 1.5), rel=0.05)


def test_report_text(spark):
    row = spark.range(1).select(
        num.money_text(F.lit(1234.5)).alias("m"), num.percent_text(F.lit(0.14298559)).alias("p"),
        num.label_prefix(F.lit("Growing Demand (Tier B)")).alias("l"), num.floor_zero(F.lit(-2.0)).alias("z"),
        num.floor_zero(F.lit(None).cast("double")).alias("n"),
    ).first()
    assert tuple(row) == ("$1,234.50", "14.30%", "Growing Demand", 0.0, None)


def test_csv_encodings(spark, tmp_path):
    utf8 = tmp_path / "utf8.csv"
    utf8.write_text("Order Date,Sales,City\n2018-01-01,1,Köln\n", encoding="utf-8")
    latin = tmp_path / "latin.csv"
    latin.write_bytes("Order Date,Sales,City\n2018-01-01,1,Köln\n".encode("latin-1"))
    for path in (utf8, latin):
        assert files.load_sales(spark, str(path)).first()["City"] == "Köln"
    bad = tmp_path / "bad.csv"
    bad.write_text("Day,Sales\n1,2\n")
    with pytest.raises(DataValidationError):
        files.load_sales(spark, str(bad))


def test_tables_round_trip_and_absence(spark, tmp_path):
    df = spark.createDataFrame([(datetime.date(2018, 1, 1), 2.0)], "Date date, Sales double")
    files.save(df, str(tmp_path / "deep" / "series"))
    assert files.load_table(spark, str(tmp_path / "deep" / "series")).collect() == df.collect()
    files.save(df, str(tmp_path / "series.csv"), fmt="csv")
    assert files.load_table(spark, str(tmp_path / "series.csv"), ("Date",)).collect() == df.collect()
    assert files.load_table(spark, str(tmp_path / "nothing")) is None


def test_preprocess_all_skips_absent(spark, tmp_path):
    (tmp_path / "train.csv").write_text("Order Date,Sales\n01/02/2018,3\n01/02/2018,3\n05/02/2018,4\n")
    out = jobs.preprocess_all(
        spark, {"sales": str(tmp_path / "train.csv"), "titles": str(tmp_path / "none.csv")}, str(tmp_path / "out"))
    assert set(out) == {"sales"}
    assert out["sales"].count() == 2


def test_every_file_in_its_own_encoding(spark, tmp_path, monkeypatch):
    """A folder of UTF-8, Latin-1 and plain files; one is damaged in its header alone."""
    folder = tmp_path / "mixed files"
    folder.mkdir()
    for name, city, encoding in (("a", "Köln", "latin-1"), ("b", "Zürich", "utf-8"), ("c", "Rome", "ascii"), ("d", "Málaga", "latin-1")):
        (folder / f"{name}.csv").write_bytes(f"Order Date,Größe,City\n2018-01-01,1,{city}\n".encode(encoding if encoding != "ascii" else "latin-1"))
    seen = []
    read = files._read_csv

    def watched(spark, paths, encoding, *more, **rest):
        if not rest:
            seen.append((encoding, len(paths)))
        return read(spark, paths, encoding, *more, **rest)

    monkeypatch.setattr(files, "_read_csv", watched)
    got = files.load_csv(spark, str(folder))
    assert got.columns == ["Order Date", "Größe", "City"]
    assert sorted(r["City"] for r in got.collect()) == ["Köln", "Málaga", "Rome", "Zürich"]
    assert ("ISO-8859-1", 3) in seen and ("UTF-8", 1) in seen


def test_registered_data_set(spark, tmp_path):
    (tmp_path / "stock.csv").write_text("Item,Stock\na,1\nb,x\n")
    (tmp_path / "other.csv").write_text("Name\nb\n")
    jobs.register_data_set("stock", ("Item", "Stock"), (lambda df: df.withColumn("Stock", F.expr("try_cast(Stock as int)")), lambda df: df.na.drop(subset=["Stock"])), "stock_clean")
    try:
        out = jobs.preprocess_all(spark, {"stock": str(tmp_path / "stock.csv"), "sales": str(tmp_path / "none.csv")}, str(tmp_path / "out"))
        assert list(out) == ["stock"] and [tuple(r) for r in out["stock"].collect()] == [("a", 1)]
        with pytest.raises(DataValidationError):
            jobs.preprocess_all(spark, {"stock": str(tmp_path / "other.csv")}, str(tmp_path / "out"))
        with pytest.raises(ValueError):
            jobs.register_data_set("stock", (), (), "again")
    finally:
        del jobs.DATA_SETS["stock"]
    with pytest.raises(ValueError):
        jobs.preprocess_all(spark, {"stock": "x"}, str(tmp_path / "out"))
