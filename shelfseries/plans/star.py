"""The sales and titles relations over a star schema of lineitem, orders, part and customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REGION_COLUMNS = {"Region", "State"}
CUSTOMER_COLUMNS = {"Segment"} | REGION_COLUMNS
PART_COLUMNS = {"Category", "Sub-Category", "Profit"}

REVENUE = "l_extendedprice * (1 - l_discount)"

EXPRESSIONS = {
    "Row ID": "concat_ws('-', l_orderkey, l_linenumber)",
    "Order ID": "l_orderkey",
    "Order Date": "to_date(o_orderdate)",
    "Ship Date": "to_date(l_shipdate)",
    "Customer ID": "o_custkey",
    "Segment": "c_mktsegment",
    "Region": "r_name",
    "State": "n_name",
    "Category": "p_type",
    "Sub-Category": "p_brand",
    "Product ID": "l_partkey",
    "Product Name": "cast(l_partkey as string)",
    "Sales": REVENUE,
    "Quantity": "l_quantity",
    "Discount": "l_discount",
    "Profit": f"{REVENUE} - l_quantity * p_retailprice",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal an input of fewer splits than cores out over the cores.

    A single-row-group file is one task however many cores there are. Inputs with
    enough splits, as any large one has, are returned unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """One row per order line with the named sales columns (all when none is named).

    Only the tables that supply a named column are joined: an inner join on a
    foreign key keeps every line, so a dimension without columns changes
    nothing. No broadcast is forced; sizes decide at run time.
    """
    wanted = list(columns) or list(EXPRESSIONS)
    named = set(wanted)
    out = spread(table(spark, folder, "lineitem"), "l_orderkey").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    if named & PART_COLUMNS:
        out = out.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if named & CUSTOMER_COLUMNS:
        who = table(spark, folder, "customer")
        if named & REGION_COLUMNS:
            places = table(spark, folder, "nation").join(
                table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
            )
            who = who.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        out = out.join(who, F.col("o_custkey") == F.col("c_custkey"))
    return out.select(*[F.expr(EXPRESSIONS[c]).alias(c) for c in wanted])


def titles(spark: SparkSession, folder: str) -> DataFrame:
    """Title rows: sales of a product in a year, split by region."""
    lines = sales(spark, folder, "Product Name", "Sub-Category", "Category", "Order Date", "Region", "Sales")

    def of(region: str) -> Column:
        return F.sum(F.when(F.col("Region") == region, F.col("Sales")).otherwise(0.0))

    main = ["AMERICA", "EUROPE", "ASIA"]
    return lines.groupBy(
        F.col("Product Name").alias("Name"), F.col("`Sub-Category`").alias("Platform"),
        F.col("Category").alias("Genre"), F.year("Order Date").alias("Year"),
    ).agg(
        of("AMERICA").alias("NA_Sales"), of("EUROPE").alias("EU_Sales"), of("ASIA").alias("JP_Sales"),
        F.sum(F.when(F.col("Region").isin(main), 0.0).otherwise(F.col("Sales"))).alias("Other_Sales"),
        F.sum("Sales").alias("Global_Sales"),
    )


def events_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Events as transactions: the day as Order Date, the value as Sales, the type as key."""
    return table(spark, folder, "events").select(
        "event_type", F.to_date("ts").alias("Order Date"), F.col("value").alias("Sales")
    )
