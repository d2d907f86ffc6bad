"""Raw layouts. Everything is read as text and coerced later, because the
cleaning counters need the raw values."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the two public retail data sets.
SALES_COLUMNS = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name",
    "Segment", "Country", "City", "State", "Postal Code", "Region", "Product ID", "Category",
    "Sub-Category", "Product Name", "Sales", "Quantity", "Discount", "Profit",
]
TITLE_COLUMNS = [
    "Rank", "Name", "Platform", "Year", "Genre", "Publisher",
    "NA_Sales", "EU_Sales", "JP_Sales", "Other_Sales", "Global_Sales",
]
SALES_REQUIRED = ["Order Date", "Sales"]
TITLES_REQUIRED = ["Name", "Year", "Global_Sales"]
REGIONAL_SALES = ["NA_Sales", "EU_Sales", "JP_Sales", "Other_Sales"]
SALES_TEXT = ["Category", "Sub-Category", "Region", "Segment", "State", "City"]
TITLES_TEXT = ["Platform", "Genre", "Publisher"]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
