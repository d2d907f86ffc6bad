"""Registry and the SQL text shared by the reference queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL that must give the same rows."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round the named columns, because sums depend on their order in the last digits."""
    # + 0.0 turns the negative zero of a rounded tiny negative into zero
    return df.withColumns({n: F.round(F.col(f"`{n}`"), digits) + F.lit(0.0) for n in names})


SALES = """sales AS (
  SELECT l_orderkey AS "Order ID", CAST(o_orderdate AS DATE) AS "Order Date", CAST(l_shipdate AS DATE) AS "Ship Date",
         o_custkey AS "Customer ID", c_mktsegment AS "Segment", r_name AS "Region", n_name AS "State",
         p_type AS "Category", p_brand AS "Sub-Category", l_partkey AS "Product ID",
         CAST(l_partkey AS VARCHAR) AS "Product Name", l_extendedprice * (1 - l_discount) AS "Sales",
         l_quantity AS "Quantity", l_discount AS "Discount",
         l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice AS "Profit",
         l_linenumber AS line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

FEATURED = SALES + """, featured AS (
  SELECT *, CAST(year("Order Date") AS INTEGER) AS "Year", CAST(month("Order Date") AS INTEGER) AS "Month",
         strftime("Order Date", '%b') AS "MonthName", CAST(quarter("Order Date") AS INTEGER) AS "Quarter",
         CAST(day("Order Date") AS INTEGER) AS "Day", CAST(isodow("Order Date") - 1 AS INTEGER) AS "DayOfWeek",
         strftime("Order Date", '%a') AS "DayName", CAST(week("Order Date") AS INTEGER) AS "WeekOfYear",
         isodow("Order Date") >= 6 AS "IsWeekend", strftime("Order Date", '%Y-%m') AS "YearMonth",
         CAST(greatest(date_diff('day', "Order Date", "Ship Date"), 0) AS INTEGER) AS "ShippingDays",
         CASE WHEN "Sales" > 0 THEN "Profit" / "Sales" END AS "ProfitMargin"
  FROM sales)"""

TITLES = SALES + """, titles AS (
  SELECT "Product Name" AS "Name", "Sub-Category" AS "Platform", "Category" AS "Genre",
         CAST(year("Order Date") AS INTEGER) AS "Year",
         sum(CASE WHEN "Region" = 'AMERICA' THEN "Sales" ELSE 0 END) AS "NA_Sales",
         sum(CASE WHEN "Region" = 'EUROPE' THEN "Sales" ELSE 0 END) AS "EU_Sales",
         sum(CASE WHEN "Region" = 'ASIA' THEN "Sales" ELSE 0 END) AS "JP_Sales",
         sum(CASE WHEN "Region" NOT IN ('AMERICA', 'EUROPE', 'ASIA') THEN "Sales" ELSE 0 END) AS "Other_Sales",
         sum("Sales") AS "Global_Sales"
  FROM sales GROUP BY 1, 2, 3, 4)"""


def period_sql(period: str, keys: list[str], source: str = "sales", span: str = "series", name: str = "panel") -> str:
    """CTEs for gap-free period totals: totals, calendar, left join."""
    bucket = {
        "day": '"Order Date"',
        "week": """CAST(date_trunc('week', "Order Date" + INTERVAL 6 DAY) AS DATE)""",
        "month": """CAST(date_trunc('month', "Order Date") AS DATE)""",
    }[period]
    step = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH"}[period]
    ks = "".join(f'"{k}", ' for k in keys)
    join = " AND ".join(['t."Date" = c."Date"', *[f't."{k}" = c."{k}"' for k in keys]])
    ck = "".join(f'c."{k}", ' for k in keys)
    grouped = f"GROUP BY {', '.join(chr(34) + k + chr(34) for k in keys)}" if keys else ""
    if span == "global":
        ends = f"""SELECT {'DISTINCT ' if keys else ''}{ks}(SELECT min("Date") FROM {name}_totals) AS lo,
                 (SELECT max("Date") FROM {name}_totals) AS hi FROM {name}_totals{'' if keys else ' LIMIT 1'}"""
    else:
        ends = f'SELECT {ks}min("Date") AS lo, max("Date") AS hi FROM {name}_totals {grouped}'
    return f"""{name}_totals AS (
  SELECT {ks}{bucket} AS "Date", sum("Sales") AS "Sales" FROM {source} GROUP BY {ks}{bucket}),
{name}_ends AS ({ends}),
{name}_calendar AS (
  SELECT {ks}CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), {step})) AS DATE) AS "Date"
  FROM {name}_ends),
{name} AS (
  SELECT {ck}c."Date", coalesce(t."Sales", 0.0) AS "Sales"
  FROM {name}_calendar c LEFT JOIN {name}_totals t ON {join})"""


EVENTS = """events_sales AS (
  SELECT event_type, CAST(ts AS DATE) AS "Order Date", value AS "Sales" FROM events)"""
