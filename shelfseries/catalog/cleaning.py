"""Data quality, cleaning and feature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import numeric as num
from ..operators import clean, quality, quantiles, rollup, windows
from ..plans import star
from .base import FEATURED, SALES, TITLES, period_sql, query, rounded

TEXT_COLUMNS = ["Order ID", "Order Date", "Ship Date", "Region", "Category", "Sales", "Profit"]


def text_export(spark: SparkSession, folder: str) -> DataFrame:
    """The sales relation as an untidy text export.

    Three date formats and some junk, text in place of some amounts, negative
    amounts, padded labels, and the first line of every order exported twice.
    """
    lines = star.sales(spark, folder, *TEXT_COLUMNS, "Row ID")
    order, day = F.col("Order ID"), F.col("Order Date")
    text = lines.select(
        order.cast("string").alias("Order ID"),
        F.when(order % 4 == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(order % 4 == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(order % 4 == 2, F.date_format(day, "MM/dd/yyyy"))
        .when(order % 40 == 3, F.lit("not a date"))
        .otherwise(F.date_format(day, "yyyy-MM-dd")).alias(" Order Date "),
        F.date_format("Ship Date", "yyyy-MM-dd").alias("Ship Date"),
        F.concat(F.lit("  "), "Region", F.lit(" ")).alias("Region"),
        F.col("Category"),
        F.when(order % 50 == 7, F.lit("n/a"))
        .when(order % 50 == 9, F.concat(F.lit("-"), F.col("Sales").cast("string")))
        .otherwise(F.col("Sales").cast("string")).alias("Sales"),
        F.col("Profit").cast("string").alias("Profit"),
        F.col("Row ID"),
    )
    copies = F.when(F.col("Row ID").endswith("-1"), F.lit(2)).otherwise(F.lit(1))
    return text.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


TEXT_EXPORT = SALES + """, export AS (
  SELECT CAST("Order ID" AS VARCHAR) AS "Order ID",
         CASE WHEN "Order ID" % 4 = 0 THEN strftime("Order Date", '%d/%m/%Y')
              WHEN "Order ID" % 4 = 1 THEN strftime("Order Date", '%Y-%m-%d')
              WHEN "Order ID" % 4 = 2 THEN strftime("Order Date", '%m/%d/%Y')
              WHEN "Order ID" % 40 = 3 THEN 'not a date'
              ELSE strftime("Order Date", '%Y-%m-%d') END AS "Order Date",
         strftime("Ship Date", '%Y-%m-%d') AS "Ship Date", '  ' || "Region" || ' ' AS "Region", "Category",
         CASE WHEN "Order ID" % 50 = 7 THEN 'n/a'
              WHEN "Order ID" % 50 = 9 THEN '-' || CAST("Sales" AS VARCHAR)
              ELSE CAST("Sales" AS VARCHAR) END AS "Sales",
         CAST("Profit" AS VARCHAR) AS "Profit", "Order ID" || '-' || line AS "Row ID"
  FROM sales, generate_series(1, CASE WHEN line = 1 THEN 2 ELSE 1 END)),
typed AS (
  SELECT "Order ID", "Row ID", "Region", "Category",
         CAST(try_strptime("Order Date", ['%d/%m/%Y', '%Y-%m-%d', '%m/%d/%Y']) AS DATE) AS "Order Date",
         CAST("Ship Date" AS DATE) AS "Ship Date", TRY_CAST("Sales" AS DOUBLE) AS "Sales",
         TRY_CAST("Profit" AS DOUBLE) AS "Profit"
  FROM (SELECT DISTINCT * FROM export)),
uncapped AS (
  SELECT "Order ID", "Row ID", trim("Region") AS "Region", trim("Category") AS "Category", "Order Date", "Ship Date",
         greatest("Sales", 0.0) AS "Sales", "Profit"
  FROM typed WHERE "Order Date" IS NOT NULL AND "Sales" IS NOT NULL),
quartiles AS (SELECT quantile_cont("Sales", 0.25) AS q1, quantile_cont("Sales", 0.75) AS q3 FROM uncapped),
cleaned AS (
  SELECT u.* EXCLUDE ("Sales"), least(greatest("Sales", q1 - 3.0 * (q3 - q1)), q3 + 3.0 * (q3 - q1)) AS "Sales"
  FROM uncapped u, quartiles)"""


@query("raw_line_counters", f"""WITH {TEXT_EXPORT}
SELECT count(*) AS row_count, count(*) FILTER (WHERE "Order Date" IS NULL) AS bad_dates,
       count(*) FILTER (WHERE "Sales" IS NULL) AS bad_numbers, count(*) FILTER (WHERE "Sales" < 0) AS negatives,
       count(*) FILTER (WHERE "Sales" < 100 OR "Sales" > 50000) AS capped
FROM typed""")
def raw_line_counters(spark, folder):
    df = clean.drop_exact_duplicates(clean.strip_column_names(text_export(spark, folder)))
    return quality.cleaning_counts(df, clean.parse_date(df, "Order Date"), clean.to_number("Sales"), 100.0, 50000.0)


@query("raw_duplicates", f"""WITH {TEXT_EXPORT}
SELECT (SELECT count(*) FROM export) - (SELECT count(*) FROM (SELECT DISTINCT * FROM export)) AS duplicates""")
def raw_duplicates(spark, folder):
    return quality.duplicate_count(text_export(spark, folder))


@query("raw_date_formats", f"""WITH {TEXT_EXPORT}
SELECT CASE WHEN try_strptime("Order Date", '%d/%m/%Y') IS NOT NULL THEN 'd/M/yyyy'
            WHEN try_strptime("Order Date", '%Y-%m-%d') IS NOT NULL THEN 'yyyy-MM-dd'
            WHEN try_strptime("Order Date", '%m/%d/%Y') IS NOT NULL THEN 'M/d/yyyy'
            ELSE 'none' END AS date_format, count(*) AS row_count
FROM export GROUP BY 1""")
def raw_date_formats(spark, folder):
    return clean.date_format_counts(clean.strip_column_names(text_export(spark, folder)), "Order Date")


@query("missing_values", f"""WITH {SALES}, {period_sql("month", ["Region"])},
lags AS (SELECT lag("Sales", 1) OVER w AS lag_1, lag("Sales", 2) OVER w AS lag_2, lag("Sales", 3) OVER w AS lag_3
         FROM panel WINDOW w AS (PARTITION BY "Region" ORDER BY "Date"))
SELECT column_name, missing_count, round(missing_count / n * 100.0, 2) AS missing_pct FROM (
  SELECT 'lag_1' AS column_name, count(*) - count(lag_1) AS missing_count, count(*) AS n FROM lags UNION ALL
  SELECT 'lag_2', count(*) - count(lag_2), count(*) FROM lags UNION ALL
  SELECT 'lag_3', count(*) - count(lag_3), count(*) FROM lags)
WHERE missing_count > 0""")
def missing_values(spark, folder):
    panel = rollup.monthly(star.sales(spark, folder, "Order Date", "Region", "Sales"), ("Region",))
    return quality.missingness(windows.lagged(panel, ("Region",), complete=False))


@query("table_profile", f"""WITH {SALES}
SELECT CAST(p.pos AS INTEGER) AS position, p.name AS column_name, p.kind AS data_type, n AS row_count FROM
 (VALUES (0, 'Order ID', 'bigint'), (1, 'Order Date', 'date'), (2, 'Region', 'string'), (3, 'Sales', 'double')) p(pos, name, kind),
 (SELECT count(*) AS n FROM sales)""")
def table_profile(spark, folder):
    return quality.profile(star.sales(spark, folder, "Order ID", "Order Date", "Region", "Sales"))


@query("first_lines", f"""WITH {SALES}
SELECT "Order ID", "Product ID", "Order Date", round("Sales", 4) AS "Sales" FROM sales
ORDER BY "Order ID", "Product ID", "Sales" LIMIT 5""")
def first_lines(spark, folder):
    df = star.sales(spark, folder, "Order ID", "Product ID", "Order Date", "Sales")
    return rounded(quality.head(df, ["Order ID", "Product ID", "Sales"]), 4, "Sales")


@query("history_check", f"""WITH {SALES}, {period_sql("month", ["State", "Sub-Category"])}
SELECT "State", "Sub-Category", count(*) AS n_periods, count(*) >= 120 AS enough_history
FROM panel GROUP BY 1, 2""")
def history_check(spark, folder):
    keys = ("State", "Sub-Category")
    panel = rollup.monthly(star.sales(spark, folder, "Order Date", *keys, "Sales"), keys)
    return quality.history_check(panel, keys, val_periods=60)


@query("distinct_lines", f"""WITH {TEXT_EXPORT}
SELECT "Order ID", "Row ID", "Order Date", round(TRY_CAST("Sales" AS DOUBLE), 4) AS "Sales"
FROM (SELECT DISTINCT * FROM export)""")
def distinct_lines(spark, folder):
    df = clean.drop_exact_duplicates(clean.strip_column_names(text_export(spark, folder)))
    return df.select("Order ID", "Row ID", "Order Date", F.round(clean.to_number("Sales"), 4).alias("Sales"))


@query("non_negative_amounts", f"""WITH {TEXT_EXPORT}
SELECT trim("Region") AS "Region", round(sum(greatest(coalesce("Sales", 0.0), 0.0)), 4) AS "Sales", count(*) AS n
FROM typed GROUP BY 1""")
def non_negative_amounts(spark, folder):
    df = clean.trim_text(clean.drop_exact_duplicates(clean.strip_column_names(text_export(spark, folder))), ["Region"])
    df = df.withColumn("Sales", num.non_negative(clean.to_number("Sales")))
    return rounded(df.groupBy("Region").agg(F.sum("Sales").alias("Sales"), F.count(F.lit(1)).alias("n")), 4, "Sales")


@query("capped_sales", f"""WITH {SALES},
quartiles AS (SELECT quantile_cont("Sales", 0.25) AS q1, quantile_cont("Sales", 0.75) AS q3 FROM sales)
SELECT "Order ID", line, round(least(greatest("Sales", q1 - 0.5 * (q3 - q1)), q3 + 0.5 * (q3 - q1)), 4) AS "Sales"
FROM sales, quartiles""")
def capped_sales(spark, folder):
    df = star.sales(spark, folder, "Order ID", "Row ID", "Sales")
    capped = quantiles.winsorize(df, "Sales", 0.5)
    line = F.split_part("Row ID", F.lit("-"), F.lit(2)).cast("int")
    return rounded(capped.select("Order ID", line.alias("line"), "Sales"), 4, "Sales")


@query("sales_fences", f"""WITH {SALES},
quartiles AS (SELECT quantile_cont("Sales", 0.25) AS q1, quantile_cont("Sales", 0.75) AS q3 FROM sales)
SELECT round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
       (SELECT count(*) FROM sales, quartiles q
        WHERE "Sales" < q.q1 - 1.5 * (q.q3 - q.q1) OR "Sales" > q.q3 + 1.5 * (q.q3 - q.q1)) AS capped
FROM quartiles""")
def sales_fences(spark, folder):
    df = star.sales(spark, folder, "Sales")
    lower, upper = quantiles.iqr_fences(df, "Sales", 1.5)
    return df.agg(
        F.lit(round(lower, 6)).alias("lower"), F.lit(round(upper, 6)).alias("upper"),
        F.count_if((F.col("Sales") < lower) | (F.col("Sales") > upper)).alias("capped"),
    )


@query("plausible_years", f"""WITH {TITLES}
SELECT "Year", count(*) AS n, round(sum("Global_Sales"), 4) AS "Global_Sales"
FROM titles WHERE "Year" BETWEEN 1970 AND 1999 GROUP BY 1""")
def plausible_years(spark, folder):
    kept = clean.keep_years(star.titles(spark, folder), "Year", last=1999)
    return rounded(kept.groupBy("Year").agg(F.count(F.lit(1)).alias("n"), F.sum("Global_Sales").alias("Global_Sales")), 4, "Global_Sales")


@query("filtered_lines", f"""WITH {SALES}
SELECT "Order ID", "Order Date", "State", round("Sales", 4) AS "Sales" FROM sales
WHERE "Region" = 'EUROPE' AND "Category" = 'PROMO'""")
def filtered_lines(spark, folder):
    df = star.sales(spark, folder, "Order ID", "Order Date", "State", "Region", "Category", "Sales")
    return rounded(clean.narrow(df, "EUROPE", "PROMO").select("Order ID", "Order Date", "State", "Sales"), 4, "Sales")


@query("filter_values", f"""WITH {SALES}
SELECT DISTINCT 'Region' AS dimension, "Region" AS value FROM sales UNION ALL
SELECT DISTINCT 'Category', "Category" FROM sales""")
def filter_values(spark, folder):
    df = star.sales(spark, folder, "Region", "Category")
    parts = [clean.distinct_values(df, c).select(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in df.columns]
    return parts[0].unionByName(parts[1])


@query("clean_sales", f"""WITH {TEXT_EXPORT}
SELECT "Order ID", "Row ID", "Region", "Category", "Order Date", "Ship Date", round("Sales", 4) AS "Sales",
       round("Profit", 4) AS "Profit" FROM cleaned""")
def clean_sales(spark, folder):
    df = clean.clean_sales(text_export(spark, folder))
    return rounded(df.select(
        "Order ID", "Row ID", "Region", "Category", "Order Date", "Ship Date", "Sales",
        clean.to_number("Profit").alias("Profit"),
    ), 4, "Sales", "Profit")


@query("clean_sales_features", f"""WITH {TEXT_EXPORT}
SELECT "Order ID", "Row ID", CAST(year("Order Date") AS INTEGER) AS "Year", CAST(month("Order Date") AS INTEGER) AS "Month",
       strftime("Order Date", '%b') AS "MonthName", CAST(quarter("Order Date") AS INTEGER) AS "Quarter",
       CAST(day("Order Date") AS INTEGER) AS "Day", CAST(isodow("Order Date") - 1 AS INTEGER) AS "DayOfWeek",
       strftime("Order Date", '%a') AS "DayName", CAST(week("Order Date") AS INTEGER) AS "WeekOfYear",
       isodow("Order Date") >= 6 AS "IsWeekend", strftime("Order Date", '%Y-%m') AS "YearMonth",
       CAST(greatest(date_diff('day', "Order Date", "Ship Date"), 0) AS INTEGER) AS "ShippingDays",
       round(CASE WHEN "Sales" > 0 THEN "Profit" / "Sales" END, 6) AS "ProfitMargin"
FROM cleaned""")
def clean_sales_features(spark, folder):
    df = clean.sales_features(clean.clean_sales(text_export(spark, folder)))
    return rounded(df.select(
        "Order ID", "Row ID", *cal.calendar_columns("Order Date"), "ShippingDays", "ProfitMargin"
    ), 6, "ProfitMargin")


CLEAN_TITLES = TITLES + """, kept AS (SELECT * FROM titles WHERE "Year" BETWEEN 1970 AND 2026),
quartiles AS (SELECT quantile_cont("Global_Sales", 0.25) AS q1, quantile_cont("Global_Sales", 0.75) AS q3 FROM kept),
clean_titles AS (
  SELECT k.* EXCLUDE ("Global_Sales"),
         least(greatest("Global_Sales", q1 - 3.0 * (q3 - q1)), q3 + 3.0 * (q3 - q1)) AS "Global_Sales"
  FROM kept k, quartiles)"""
SALES_COLUMNS = ["NA_Sales", "EU_Sales", "JP_Sales", "Other_Sales", "Global_Sales"]


@query("clean_titles", f"""WITH {CLEAN_TITLES}
SELECT "Name", "Platform", "Genre", "Year", round("NA_Sales", 4) AS "NA_Sales", round("EU_Sales", 4) AS "EU_Sales",
       round("JP_Sales", 4) AS "JP_Sales", round("Other_Sales", 4) AS "Other_Sales",
       round("Global_Sales", 4) AS "Global_Sales" FROM clean_titles""")
def clean_titles(spark, folder):
    df = clean.clean_titles(star.titles(spark, folder), last_year=2026)
    return rounded(df.select("Name", "Platform", "Genre", "Year", *SALES_COLUMNS), 4, *SALES_COLUMNS)


@query("clean_titles_features", f"""WITH {CLEAN_TITLES}
SELECT "Name", "Year", make_date("Year", 1, 1) AS "ReleaseDate", CAST("Year" // 10 * 10 AS VARCHAR) || 's' AS "Decade",
       round(CASE WHEN "Global_Sales" > 0 THEN "NA_Sales" / "Global_Sales" ELSE 0 END, 6) AS "NA_Share",
       round(CASE WHEN "Global_Sales" > 0 THEN "EU_Sales" / "Global_Sales" ELSE 0 END, 6) AS "EU_Share",
       round(CASE WHEN "Global_Sales" > 0 THEN "JP_Sales" / "Global_Sales" ELSE 0 END, 6) AS "JP_Share",
       round(CASE WHEN "Global_Sales" > 0 THEN "Other_Sales" / "Global_Sales" ELSE 0 END, 6) AS "Other_Share"
FROM clean_titles""")
def clean_titles_features(spark, folder):
    df = clean.title_features(clean.clean_titles(star.titles(spark, folder), last_year=2026))
    shares = ["NA_Share", "EU_Share", "JP_Share", "Other_Share"]
    return rounded(df.select("Name", "Year", "ReleaseDate", "Decade", *shares), 6, *shares)


@query("calendar_features", f"""WITH {FEATURED}
SELECT "Year", "Month", "MonthName", "Quarter", "Day", "DayOfWeek", "DayName", "WeekOfYear", "IsWeekend", "YearMonth",
       count(*) AS n FROM featured GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10""")
def calendar_features(spark, folder):
    features = cal.calendar_columns("Order Date")
    df = star.sales(spark, folder, "Order Date").withColumns(features)
    return df.groupBy(*features).agg(F.count(F.lit(1)).alias("n"))


@query("shipping_and_margin", f"""WITH {FEATURED}
SELECT "Order ID", "line", "ShippingDays", round("ProfitMargin", 6) AS "ProfitMargin" FROM featured""")
def shipping_and_margin(spark, folder):
    df = clean.sales_features(star.sales(spark, folder, "Order ID", "Row ID", "Order Date", "Ship Date", "Sales", "Profit"))
    line = F.split_part("Row ID", F.lit("-"), F.lit(2)).cast("int")
    return rounded(df.select("Order ID", line.alias("line"), "ShippingDays", "ProfitMargin"), 6, "ProfitMargin")


@query("month_arithmetic", f"""WITH {SALES}
SELECT DISTINCT "Order Date", CAST(date_trunc('month', "Order Date") AS DATE) AS month_start,
       CAST(date_trunc('month', "Order Date") + INTERVAL 1 MONTH AS DATE) AS next_month,
       CAST(date_trunc('week', "Order Date" + INTERVAL 6 DAY) AS DATE) AS closing_monday FROM sales""")
def month_arithmetic(spark, folder):
    d = "Order Date"
    return star.sales(spark, folder, d).select(
        d, cal.month_start(d).alias("month_start"), cal.next_month(d).alias("next_month"),
        cal.closing_monday(d).alias("closing_monday"),
    ).distinct()
