"""Dashboard and report aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.calendar import DAY_NAMES, MONTH_NAMES
from ..operators import clean, kpi, rollup, segment
from ..plans import dashboard, star
from .base import FEATURED, SALES, TITLES, query, rounded


def featured(spark, folder, *columns):
    return clean.sales_features(star.sales(spark, folder, *columns))


@query("yearly_titles", f"""WITH {TITLES}
SELECT "Year", round(sum("Global_Sales"), 4) AS "Global_Sales" FROM titles GROUP BY 1""")
def yearly_titles(spark, folder):
    return rounded(rollup.yearly(star.titles(spark, folder)), 4, "Global_Sales")


@query("sales_by_category", f"""WITH {SALES}
SELECT "Category", round(sum("Sales"), 4) AS "Sales" FROM sales GROUP BY 1""")
def sales_by_category(spark, folder):
    return rounded(kpi.sales_by(star.sales(spark, folder, "Category", "Sales"), "Category"), 4, "Sales")


@query("sales_by_region", f"""WITH {SALES}
SELECT "Region", round(sum("Sales"), 4) AS "Sales" FROM sales GROUP BY 1""")
def sales_by_region(spark, folder):
    return rounded(kpi.sales_by(star.sales(spark, folder, "Region", "Sales"), "Region"), 4, "Sales")


@query("sales_hierarchy", f"""WITH {SALES}
SELECT "Category", "Sub-Category", round(sum("Sales"), 4) AS "Sales",
       CAST(2 - grouping("Category") - grouping("Sub-Category") AS INTEGER) AS level
FROM sales GROUP BY ROLLUP ("Category", "Sub-Category")""")
def sales_hierarchy(spark, folder):
    return rounded(kpi.sales_hierarchy(star.sales(spark, folder, "Category", "Sub-Category", "Sales")), 4, "Sales")


def _sum_case(column: str, value, alias: str, empty: str = "") -> str:
    shown = f"'{value}'" if isinstance(value, str) else value
    total = f'sum(CASE WHEN "{column}" = {shown} THEN "Sales" END)'
    total = f"coalesce({total}, {empty})" if empty else total
    return f'round({total}, 4) AS "{alias}"'


# the test tables hold orders of these years; the query derives the list from the data
_YEARS = range(1995, 2002)


@query("region_by_year", f"""WITH {FEATURED}
SELECT "Region", {', '.join(_sum_case('Year', y, str(y)) for y in _YEARS)} FROM featured GROUP BY 1""")
def region_by_year(spark, folder):
    df = featured(spark, folder, "Order Date", "Region", "Sales")
    years = kpi.years_of(star.table(spark, folder, "orders"), "o_orderdate")
    return rounded(kpi.region_by_year(df, years), 4, *[str(y) for y in years])


@query("year_by_month", f"""WITH {FEATURED}
SELECT "Year", {', '.join(_sum_case('MonthName', m, m) for m in MONTH_NAMES)} FROM featured GROUP BY 1""")
def year_by_month(spark, folder):
    return rounded(kpi.year_by_month(featured(spark, folder, "Order Date", "Sales")), 4, *MONTH_NAMES)


@query("month_day_heatmap", f"""WITH {FEATURED}
SELECT "MonthName", {', '.join(_sum_case('DayName', d, d, '0.0') for d in DAY_NAMES)} FROM featured GROUP BY 1""")
def month_day_heatmap(spark, folder):
    return rounded(kpi.heatmap(featured(spark, folder, "Order Date", "Sales")), 4, *DAY_NAMES)


@query("mean_shipping_days", f"""WITH {FEATURED}
SELECT "Region", round(avg("ShippingDays"), 6) AS mean_shipping_days FROM featured GROUP BY ROLLUP ("Region")""")
def mean_shipping_days(spark, folder):
    df = featured(spark, folder, "Order Date", "Ship Date", "Region", "Sales")
    return rounded(kpi.mean_shipping_days(df), 6, "mean_shipping_days")


@query("sales_kpis", f"""WITH {FEATURED}
SELECT round(sum("Sales"), 3) AS total_sales, count(*) AS line_count, round(avg("Sales"), 6) AS avg_line_sales,
       round(avg("ProfitMargin"), 6) AS avg_profit_margin FROM featured""")
def sales_kpis(spark, folder):
    out = kpi.sales_kpis(featured(spark, folder, "Order Date", "Sales", "Profit"))
    return rounded(rounded(out, 6, "avg_line_sales", "avg_profit_margin"), 3, "total_sales")


@query("filtered_kpis", f"""WITH {FEATURED}
SELECT round(sum("Sales"), 3) AS total_sales, count(*) AS line_count, round(avg("Sales"), 6) AS avg_line_sales,
       round(avg("ProfitMargin"), 6) AS avg_profit_margin FROM featured
WHERE "Region" = 'ASIA' AND "Category" = 'ECONOMY'""")
def filtered_kpis(spark, folder):
    df = featured(spark, folder, "Order Date", "Region", "Category", "Sub-Category", "Sales", "Profit")
    out = dashboard.sales_dashboard(df, "ASIA", "ECONOMY")["kpis"]
    return rounded(rounded(out, 6, "avg_line_sales", "avg_profit_margin"), 3, "total_sales")


@query("report_kpis", f"""WITH {FEATURED},
months AS (SELECT "YearMonth", sum("Sales") AS s, count(*) AS n FROM featured GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS line_count, round(sum(s), 3) AS total_sales, round(avg(s), 4) AS avg_monthly_sales
FROM months""")
def report_kpis(spark, folder):
    out = kpi.report_kpis(featured(spark, folder, "Order Date", "Sales"))
    return rounded(rounded(out, 3, "total_sales"), 4, "avg_monthly_sales")


@query("steady_growth", f"""WITH {FEATURED},
yearly AS (SELECT "State", "Year", sum("Sales") AS s FROM featured GROUP BY 1, 2),
steps AS (SELECT "State", s, lag(s) OVER (PARTITION BY "State" ORDER BY "Year") AS prev FROM yearly)
SELECT "State", bool_and(s > prev) AS always_grew FROM steps WHERE prev IS NOT NULL GROUP BY 1""")
def steady_growth(spark, folder):
    return kpi.steady_growth(featured(spark, folder, "Order Date", "State", "Sales"), "State")


@query("year_over_year", f"""WITH {FEATURED},
yearly AS (SELECT "Sub-Category", "Year", sum("Sales") AS s FROM featured GROUP BY 1, 2)
SELECT "Sub-Category", "Year", round(s, 4) AS "Sales",
       round(lag(s) OVER (PARTITION BY "Sub-Category" ORDER BY "Year"), 4) AS previous_year FROM yearly""")
def year_over_year(spark, folder):
    df = featured(spark, folder, "Order Date", "Sub-Category", "Sales")
    yearly = df.groupBy("Sub-Category", "Year").agg(F.sum("Sales").alias("Sales"))
    w = Window.partitionBy("Sub-Category").orderBy("Year")
    return rounded(yearly.withColumn("previous_year", F.lag("Sales").over(w)), 4, "Sales", "previous_year")


FEATURES_SQL = FEATURED + """, years AS (SELECT DISTINCT "Year" FROM featured),
months AS (SELECT DISTINCT "YearMonth" FROM featured),
products AS (SELECT "Product Name", sum("Sales") AS total, count(DISTINCT "Order ID") AS orders FROM featured GROUP BY 1),
by_year AS (
  SELECT p."Product Name", y."Year", coalesce(sum(f."Sales"), 0.0) AS s FROM products p CROSS JOIN years y
  LEFT JOIN featured f ON f."Product Name" = p."Product Name" AND f."Year" = y."Year" GROUP BY 1, 2),
growth AS (
  SELECT "Product Name", avg((s - prev) / (prev + 1.0)) AS g FROM (
    SELECT *, lag(s) OVER (PARTITION BY "Product Name" ORDER BY "Year") AS prev FROM by_year)
  WHERE prev IS NOT NULL GROUP BY 1),
by_month AS (
  SELECT p."Product Name", m."YearMonth", coalesce(sum(f."Sales"), 0.0) AS s FROM products p CROSS JOIN months m
  LEFT JOIN featured f ON f."Product Name" = p."Product Name" AND f."YearMonth" = m."YearMonth" GROUP BY 1, 2),
volatility AS (SELECT "Product Name", stddev_samp(s) AS v FROM by_month GROUP BY 1),
ranked AS (
  SELECT "Product Name", "Category", "Sub-Category",
         row_number() OVER (PARTITION BY "Product Name" ORDER BY count(*) DESC, "Category") AS r
  FROM featured GROUP BY 1, 2, 3),
features AS (
  SELECT p."Product Name", total AS "Total_Sales", coalesce(g, 0.0) AS "YoY_Growth", v AS "Monthly_Sales_Volatility",
         total / (orders + 1e-5) AS "Avg_Order_Value", "Category", "Sub-Category"
  FROM products p LEFT JOIN growth USING ("Product Name") JOIN volatility USING ("Product Name")
  JOIN ranked USING ("Product Name") WHERE r = 1)"""
PRODUCT_COLUMNS = ["Order ID", "Order Date", "Product Name", "Category", "Sub-Category", "Sales"]


@query("product_features", f"""WITH {FEATURES_SQL}
SELECT "Product Name", round("Total_Sales", 4) AS "Total_Sales", round("YoY_Growth", 5) AS "YoY_Growth",
       round("Monthly_Sales_Volatility", 5) AS "Monthly_Sales_Volatility",
       round("Avg_Order_Value", 5) AS "Avg_Order_Value", "Category", "Sub-Category" FROM features""")
def product_features(spark, folder):
    out = segment.product_features(featured(spark, folder, *PRODUCT_COLUMNS))
    return rounded(rounded(out, 4, "Total_Sales"), 5, "YoY_Growth", "Monthly_Sales_Volatility", "Avg_Order_Value")


@query("subcategory_features", f"""WITH {FEATURED},
base AS (SELECT "Sub-Category", sum("Sales") AS total, count(*) AS n FROM featured GROUP BY 1),
modes AS (
  SELECT "Sub-Category", "Category",
         row_number() OVER (PARTITION BY "Sub-Category" ORDER BY count(*) DESC, "Category") AS r
  FROM featured GROUP BY 1, 2)
SELECT "Sub-Category", round(total, 4) AS "Total_Sales", 0.0::DOUBLE AS "YoY_Growth", 0.0::DOUBLE AS "Monthly_Sales_Volatility",
       round(total / (n + 1e-5), 6) AS "Avg_Order_Value", "Category"
FROM base JOIN modes USING ("Sub-Category") WHERE r = 1""")
def subcategory_features(spark, folder):
    # no product name, dates or order ids: key, growth, volatility and order count fall back
    out = segment.product_features(star.sales(spark, folder, "Category", "Sub-Category", "Sales"))
    return rounded(rounded(out, 4, "Total_Sales"), 6, "Avg_Order_Value")


@query("scaled_features", f"""WITH {FEATURES_SQL},
logged AS (SELECT "Product Name", ln(1 + "Total_Sales") AS a, "YoY_Growth" AS b, ln(1 + "Monthly_Sales_Volatility") AS c,
                  ln(1 + "Avg_Order_Value") AS d FROM features),
stats AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb, avg(c) AS mc, stddev_pop(c) AS sc,
                 avg(d) AS md, stddev_pop(d) AS sd FROM logged)
SELECT "Product Name", round((a - ma) / sa, 5) AS "z_Total_Sales", round((b - mb) / sb, 5) AS "z_YoY_Growth",
       round((c - mc) / sc, 5) AS "z_Monthly_Sales_Volatility", round((d - md) / sd, 5) AS "z_Avg_Order_Value"
FROM logged, stats""")
def scaled_features(spark, folder):
    out = segment.scale_features(segment.product_features(featured(spark, folder, *PRODUCT_COLUMNS)))
    names = [f"z_{f}" for f in segment.FEATURES]
    return rounded(out.select("Product Name", *names), 5, *names)


_PLAYBOOK_SQL = " UNION ALL ".join(
    "SELECT " + ", ".join("'" + str(x).replace("'", "''") + "'" + f" AS {n}" for x, n in zip(row, ("label", "a", "b", "c")))
    for row in segment.PLAYBOOK
)
_STRATEGY_SQL = " UNION ALL ".join(f"SELECT '{label}' AS label, '{text}' AS s" for label, text in segment.STRATEGIES)
_LABELLED_SQL = f"""labelled AS (
  SELECT "Category", "Sub-Category", sum("Sales") AS s, count(*) AS n,
         CASE CAST(substr("Sub-Category", 7) AS INTEGER) % 5 WHEN 0 THEN '{segment.HIGH} (Tier B)' WHEN 1 THEN '{segment.LOW}'
              WHEN 2 THEN '{segment.GROWING}' WHEN 3 THEN '{segment.DECLINING}' ELSE 'Unnamed' END AS "ClusterLabel"
  FROM sales GROUP BY 1, 2)"""


def _labelled(spark, folder):
    """Sales of each category pair under a label that depends on the brand number, one of them unknown."""
    df = star.sales(spark, folder, "Category", "Sub-Category", "Sales")
    tier = F.substring("Sub-Category", 7, 10).cast("int") % 5
    return df.groupBy("Category", "Sub-Category").agg(F.sum("Sales").alias("Sales")).withColumn(
        "ClusterLabel",
        F.when(tier == 0, f"{segment.HIGH} (Tier B)").when(tier == 1, segment.LOW)
        .when(tier == 2, segment.GROWING).when(tier == 3, segment.DECLINING).otherwise("Unnamed"),
    )


@query("segment_playbook", f"""WITH {SALES}, {_LABELLED_SQL}, playbook AS ({_PLAYBOOK_SQL})
SELECT "Category", "Sub-Category", round(s, 4) AS "Sales", "ClusterLabel",
       coalesce(a, 'Standard inventory reviews.') AS "Replenishment", coalesce(b, 'General promotions.') AS "Marketing",
       coalesce(c, 'Monitor performance.') AS "Strategy"
FROM labelled LEFT JOIN playbook ON split_part("ClusterLabel", ' (', 1) = label""")
def segment_playbook(spark, folder):
    return rounded(segment.with_playbook(_labelled(spark, folder)), 4, "Sales")


@query("segment_strategy", f"""WITH {SALES}, {_LABELLED_SQL}, strategies AS ({_STRATEGY_SQL}),
sizes AS (SELECT "ClusterLabel", count(*) AS n FROM labelled GROUP BY 1)
SELECT "ClusterLabel", n AS "Product_Count", coalesce(s, 'Standard inventory review') AS "Core_Strategy"
FROM sizes LEFT JOIN strategies ON split_part("ClusterLabel", ' (', 1) = label""")
def segment_strategy(spark, folder):
    return segment.with_strategy(segment.segment_sizes(_labelled(spark, folder)))


@query("segment_members", f"""WITH {SALES}, {_LABELLED_SQL}
SELECT "Category", "Sub-Category", round(s, 4) AS "Revenue ($)" FROM labelled WHERE "ClusterLabel" = '{segment.GROWING}'""")
def segment_members(spark, folder):
    return rounded(
        _labelled(spark, folder).where(F.col("ClusterLabel") == segment.GROWING)
        .select("Category", "Sub-Category", F.col("Sales").alias("Revenue ($)")), 4, "Revenue ($)"
    )
