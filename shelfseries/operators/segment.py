"""Demand segmentation of products."""

from __future__ import annotations

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import label_prefix
from ..sources.staging import hold
from .kmeans import fit_many, nearest_centre

FEATURES = ["Total_Sales", "YoY_Growth", "Monthly_Sales_Volatility", "Avg_Order_Value"]
LOGGED = ["Total_Sales", "Monthly_Sales_Volatility", "Avg_Order_Value"]
STARTS = 10
SEED = 42

# Segment names, their playbook and their one-line strategies.
HIGH, LOW = "High Volume, Stable Demand", "Low Volume, High Volatility"
GROWING, DECLINING = "Growing Demand", "Declining Demand"
PLAYBOOK = [
    (HIGH,
     "Automated replenishment (Min-Max system); maintain high safety stock.",
     "Loyalty programs, bulk discounts, and long-term customer contracts.",
     "Core revenue driver. Focus on supplier stability and cost-efficiency."),
    (LOW,
     "Drop-ship model or make-to-order if possible; clear excess stock immediately.",
     "Clearance sales, deep discount bundles, or liquidations.",
     "Inventory risk. Assess whether to phase out these SKUs entirely."),
    (GROWING,
     "Dynamic safety stock tied directly to monthly forecasts; build stock ahead of peak seasons.",
     "Pre-season promotions, early-booking discounts, and seasonal bundling.",
     "High-leverage. Plan warehouse capacity carefully around peaks."),
    (DECLINING,
     "Low, steady safety stock. Consolidate orders to reduce shipping costs.",
     "Cross-sell or bundle with 'Consistent Performers' to increase order value.",
     "Stable long-tail. Keep SKU overhead low; do not over-promote."),
]
PLAYBOOK_DEFAULT = ("Standard inventory reviews.", "General promotions.", "Monitor performance.")
STRATEGIES = [
    (HIGH, "Automated Min-Max replenishment, high safety stock"),
    (GROWING, "Dynamic safety stock tied to peaks, pre-season capacity planning"),
    (DECLINING, "Low, steady safety stock, consolidated purchasing runs"),
    (LOW, "Make-to-order, drop-shipping, or deep clearance discount campaigns"),
]
STRATEGY_DEFAULT = "Standard inventory review"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def product_key(df: DataFrame) -> str:
    """Product Name, else Sub-Category, else Category."""
    return next(c for c in ("Product Name", "Sub-Category", "Category") if c in df.columns)


def product_features(df: DataFrame, key: str | None = None, approximate_orders: bool = False) -> DataFrame:
    """Sales, growth, volatility and order value of each product.

    Two passes over the transactions: one to product-month totals (everything
    but the order count comes from that small table), one for the distinct
    orders, which Spark de-duplicates by (product, order) before counting, so a
    hot product is spread out. Growth and volatility count absent years and
    months as 0 without writing them out. The history that follows the product-month
    totals stays where the product is: one shuffle deals them out for all its steps.
    """
    key = key or product_key(df)
    metas = [m for m in ("Category", "Sub-Category") if m in df.columns and m != key]
    times = [c for c in ("Year", "YearMonth") if c in df.columns]
    monthly = df.groupBy(_c(key), *[_c(m) for m in metas], *times).agg(
        F.sum("Sales").alias("s"), F.count(F.lit(1)).alias("n")
    )
    monthly = hold(monthly, "product-months")

    if "Order ID" in df.columns:
        counter = F.approx_count_distinct if approximate_orders else F.count_distinct
        orders = df.groupBy(_c(key)).agg(counter(_c("Order ID")).alias("orders"))
    else:
        orders = monthly.groupBy(_c(key)).agg(F.sum("n").alias("orders"))
    out = _sales_history(monthly, key).join(orders, key).withColumn(
        "Avg_Order_Value", F.col("Total_Sales") / (F.col("orders") + 1e-5)
    )
    if metas:
        out = out.join(_most_frequent(monthly, key, metas), key)
    return out.select(_c(key), *FEATURES, *[_c(m) for m in metas])


def _sales_history(monthly: DataFrame, key: str) -> DataFrame:
    """Total sales, yearly growth and monthly volatility of each product, in one chain of aggregations.

    Growth is the mean of (next - this) / (this + 1) over consecutive years of
    the whole data. A pair of years contributes only if the product sold in one
    of them: a present year against the year before (0 if absent), and a present
    year followed by an absent one. Volatility is the sample deviation over all
    N months of the data; absent months add nothing to the sums it needs.
    """
    has_year, has_month = "Year" in monthly.columns, "YearMonth" in monthly.columns
    if not has_year:
        monthly = monthly.withColumn("Year", F.lit(0))
    if not has_month:
        monthly = monthly.withColumn("YearMonth", F.lit(""))
    # one row per calendar year
    years = monthly.select("Year").distinct().select(
        "Year", (F.row_number().over(Window.orderBy("Year")) - 1).alias("pos")
    ).withColumn("pairs", F.max("pos").over(Window.partitionBy()))
    months = monthly.agg(F.count_distinct("YearMonth")).scalar()

    yearly = (
        monthly.repartition(_c(key)).groupBy(_c(key), "Year", "YearMonth").agg(F.sum("s").alias("s"))
        .groupBy(_c(key), "Year").agg(F.sum("s").alias("s"), F.sum(F.col("s") * F.col("s")).alias("squares"))
        .join(F.broadcast(years), "Year")
    )
    w = Window.partitionBy(_c(key)).orderBy("pos")
    s, pos, pairs = F.col("s"), F.col("pos"), F.col("pairs")
    placed = yearly.withColumns({
        "before": F.when(F.lag(pos).over(w) == pos - 1, F.lag(s).over(w)).otherwise(F.lit(0.0)),
        "ends": (pos < pairs) & F.coalesce(F.lead(pos).over(w) != pos + 1, F.lit(True)),
    })
    rise = F.when(pos > 0, (s - F.col("before")) / (F.col("before") + 1.0)).otherwise(F.lit(0.0))
    fall = F.when(F.col("ends"), -s / (s + 1.0)).otherwise(F.lit(0.0))
    growth = F.coalesce(F.sum(rise + fall) / F.nullif(F.max(pairs), F.lit(0)), F.lit(0.0))
    totals = placed.groupBy(_c(key)).agg(
        F.sum(s).alias("Total_Sales"), growth.alias("YoY_Growth"), F.sum("squares").alias("squares")
    )
    totals = totals.withColumn("months", months)
    n, total = F.col("months"), F.col("Total_Sales")
    spread = F.sqrt(F.greatest(F.col("squares") - total * total / n, F.lit(0.0)) / (n - 1))
    volatility = F.when(n > 1, spread) if has_month else F.lit(0.0)
    return totals.select(
        _c(key), "Total_Sales", "YoY_Growth", volatility.alias("Monthly_Sales_Volatility")
    )


def _most_frequent(monthly: DataFrame, key: str, metas: list[str]) -> DataFrame:
    """The most frequent value of each attribute, smallest on ties, "Unknown" when there is none."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), _c(m).alias("v")) for i, m in enumerate(metas)])
    counts = (
        monthly.select(_c(key), "n", F.explode(pairs).alias("p"))
        .groupBy(_c(key), "p.i", "p.v").agg(F.sum("n").alias("n"))
    )
    best = [
        F.min_by(F.col("v"), F.when((F.col("i") == i) & F.col("v").isNotNull(), F.struct(-F.col("n"), "v")))
        for i in range(len(metas))
    ]
    return counts.groupBy(_c(key)).agg(*[F.coalesce(b, F.lit("Unknown")).alias(m) for b, m in zip(best, metas)])


def scale_features(features: DataFrame) -> DataFrame:
    """Adds ``z_<feature>``: log of the skewed ones, then standardised by the population deviation.

    The features are held: their statistics and the scaling read them, and neither works them out again.
    """
    features = hold(features, "features")
    logged = {f: F.log1p(_c(f)) if f in LOGGED else _c(f) for f in FEATURES}
    stats = features.agg(F.struct(
        *[F.avg(e).alias(f"a_{f}") for f, e in logged.items()],
        *[F.stddev_pop(e).alias(f"d_{f}") for f, e in logged.items()],
    )).scalar()
    mean, spread = ({f: F.col("_stats")[f"{p}_{f}"] for f in FEATURES} for p in ("a", "d"))
    scaled = {
        f"z_{f}": F.when(spread[f] > 0, (e - mean[f]) / spread[f]).otherwise(F.lit(0.0)) for f, e in logged.items()
    }
    return features.withColumn("_stats", stats).withColumns(scaled).drop("_stats")


def with_vector(scaled: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"z_{f}" for f in FEATURES], outputCol="features").transform(scaled)


SCALED = [f"z_{f}" for f in FEATURES]


def elbow(scaled: DataFrame, max_k: int = 10, starts: int = STARTS) -> DataFrame:
    """Inertia for k = 1..max_k as rows ``(k, Inertia)``, the best of several starts; all fits run together."""
    points = hold(scaled.select(*SCALED), "segment-points")
    best = fit_many(points, SCALED, list(range(1, max_k + 1)), starts, SEED)
    rows = [(k, cost) for k, (_, cost) in sorted(best.items())]
    return scaled.sparkSession.createDataFrame(rows, "k int, Inertia double")


def label_clusters(clustered: DataFrame) -> DataFrame:
    """Adds ClusterLabel to a four-cluster table from the cluster means.

    Highest mean sales and lowest mean sales name two; of the middle two the one
    that grows more is growing (on a tie, the one with higher sales).
    """
    # four rows
    stats = clustered.groupBy("Cluster").agg(
        F.avg("Total_Sales").alias("sales"), F.avg("YoY_Growth").alias("growth")
    )
    rank = F.row_number().over(Window.orderBy("sales", "Cluster"))
    ranked = stats.withColumn("rank", rank)
    middle = Window.partitionBy(F.col("rank").between(2, 3)).orderBy(F.desc("growth"), F.desc("rank"))
    labels = ranked.withColumn("by_growth", F.row_number().over(middle)).select(
        "Cluster",
        F.when(F.col("rank") == 4, HIGH).when(F.col("rank") == 1, LOW)
        .when(F.col("by_growth") == 1, GROWING).otherwise(DECLINING).alias("ClusterLabel"),
    )
    return clustered.join(F.broadcast(labels), "Cluster")


def segment(scaled: DataFrame, k: int = 4, starts: int = STARTS) -> DataFrame:
    """Product features with Cluster and ClusterLabel (and the scaled columns)."""
    if k != 4:
        raise ValueError("the segment names are defined for exactly four clusters")
    scaled = hold(scaled, "scaled-features")
    centres, _ = fit_many(scaled, SCALED, [k], starts, SEED)[k]
    return label_clusters(scaled.withColumn("Cluster", nearest_centre(SCALED, centres)))


def project(segmented: DataFrame, key: str) -> DataFrame:
    """Two principal components of the scaled features, with labels and rounded features.

    Works on a stored segment table too: the scaled columns are rebuilt when absent.
    The sign of a component is free; its largest loading is made positive.
    """
    if f"z_{FEATURES[0]}" not in segmented.columns:
        segmented = scale_features(segmented)
    vectors = with_vector(segmented)
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(vectors.select("features"))
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(2)]
    pc = vector_to_array("pc")
    keep = [c for c in ("Category",) if c in segmented.columns]
    return model.transform(vectors).select(
        _c(key),
        (pc[0] * signs[0]).alias("PCA1"),
        (pc[1] * signs[1]).alias("PCA2"),
        "Cluster",
        "ClusterLabel",
        F.round("Total_Sales", 2).alias("Total_Sales"),
        F.round("YoY_Growth", 4).alias("YoY_Growth"),
        F.round("Monthly_Sales_Volatility", 3).alias("Monthly_Sales_Volatility"),
        F.round("Avg_Order_Value", 2).alias("Avg_Order_Value"),
        *[_c(c) for c in keep],
    )


def with_playbook(df: DataFrame, label_col: str = "ClusterLabel") -> DataFrame:
    """Adds Replenishment, Marketing and Strategy for a label (a bracketed suffix is ignored)."""
    table = df.sparkSession.createDataFrame(
        PLAYBOOK, "_label string, Replenishment string, Marketing string, Strategy string"
    )
    names = ("Replenishment", "Marketing", "Strategy")
    return (
        df.withColumn("_label", label_prefix(label_col)).join(F.broadcast(table), "_label", "left")
        .withColumns({n: F.coalesce(F.col(n), F.lit(d)) for n, d in zip(names, PLAYBOOK_DEFAULT)})
        .drop("_label")
    )


def segment_sizes(segmented: DataFrame) -> DataFrame:
    """Products per segment, largest first."""
    return segmented.groupBy("ClusterLabel").agg(F.count(F.lit(1)).alias("Product_Count")).orderBy(
        F.desc("Product_Count"), "ClusterLabel"
    )


def with_strategy(df: DataFrame, label_col: str = "ClusterLabel") -> DataFrame:
    """Adds the one-line Core_Strategy of a label."""
    table = df.sparkSession.createDataFrame(STRATEGIES, "_label string, Core_Strategy string")
    return (
        df.withColumn("_label", label_prefix(label_col)).join(F.broadcast(table), "_label", "left")
        .withColumn("Core_Strategy", F.coalesce("Core_Strategy", F.lit(STRATEGY_DEFAULT))).drop("_label")
    )


def cluster_profile(segmented: DataFrame) -> DataFrame:
    """Mean sales, volatility and growth per cluster."""
    return segmented.groupBy("Cluster", "ClusterLabel").agg(
        F.avg("Total_Sales").alias("mean_sales"),
        F.avg("Monthly_Sales_Volatility").alias("mean_volatility"),
        F.avg("YoY_Growth").alias("mean_growth"),
    )


def members(segmented: DataFrame, label: str, key: str) -> DataFrame:
    """Display table of the products in one segment."""
    keep = [c for c in ("Category",) if c in segmented.columns]
    return segmented.where(F.col("ClusterLabel") == label).select(
        _c(key), *keep,
        F.col("Total_Sales").alias("Revenue ($)"),
        F.col("Avg_Order_Value").alias("Order Value ($)"),
        F.col("Monthly_Sales_Volatility").alias("Volatility Index"),
        F.col("YoY_Growth").alias("Growth"),
    )
