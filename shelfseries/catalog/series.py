"""Period series and window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..forecast import models
from ..operators import anomaly, kpi, rollup, tsstats, windows
from ..plans import star
from .base import EVENTS, SALES, period_sql, query, rounded


def _lines(spark, folder, *keys):
    return star.sales(spark, folder, "Order Date", "Sales", *keys)


def _monthly(spark, folder, *keys, **kw) -> DataFrame:
    return rollup.monthly(_lines(spark, folder, *keys), keys, **kw)


def _weekly(spark, folder, *keys, **kw) -> DataFrame:
    return rollup.weekly(_lines(spark, folder, *keys), keys, **kw)


@query("monthly_sales_by_region", f"""WITH {SALES}, {period_sql("month", ["Region"])}
SELECT "Region", "Date", round("Sales", 4) AS "Sales",
       round(avg("Sales") OVER (PARTITION BY "Region" ORDER BY "Date" ROWS 2 PRECEDING), 5) AS "Rolling_3M" FROM panel""")
def monthly_sales_by_region(spark, folder):
    out = windows.trailing_mean(_monthly(spark, folder, "Region"), ("Region",))
    return rounded(rounded(out, 4, "Sales"), 5, "Rolling_3M")


@query("daily_sales", f"""WITH {SALES}, {period_sql("day", [])} SELECT "Date", round("Sales", 4) AS "Sales" FROM panel""")
def daily_sales(spark, folder):
    return rounded(rollup.daily(_lines(spark, folder)), 4, "Sales")


@query("weekly_sales", f"""WITH {SALES}, {period_sql("week", [])} SELECT "Date", round("Sales", 4) AS "Sales" FROM panel""")
def weekly_sales(spark, folder):
    return rounded(_weekly(spark, folder), 4, "Sales")


@query("monthly_sales", f"""WITH {SALES}, {period_sql("month", [])} SELECT "Date", round("Sales", 4) AS "Sales" FROM panel""")
def monthly_sales(spark, folder):
    return rounded(_monthly(spark, folder), 4, "Sales")


@query("daily_by_subcategory", f"""WITH {SALES}, {period_sql("day", ["Sub-Category"])}
SELECT "Sub-Category", "Date", round("Sales", 4) AS "Sales" FROM panel""")
def daily_by_subcategory(spark, folder):
    return rounded(rollup.daily(_lines(spark, folder, "Sub-Category"), ("Sub-Category",)), 4, "Sales")


@query("weekly_by_customer_segment", f"""WITH {SALES}, {period_sql("week", ["Segment", "Region"])}
SELECT "Segment", "Region", "Date", round("Sales", 4) AS "Sales" FROM panel""")
def weekly_by_customer_segment(spark, folder):
    return rounded(_weekly(spark, folder, "Segment", "Region"), 4, "Sales")


@query("monthly_by_product_full_span", f"""WITH {SALES}, {period_sql("month", ["Product Name"], span="global")}
SELECT "Product Name", "Date", round("Sales", 4) AS "Sales" FROM panel""")
def monthly_by_product_full_span(spark, folder):
    return rounded(_monthly(spark, folder, "Product Name", span="global"), 4, "Sales")


@query("daily_events", f"""WITH {EVENTS}, {period_sql("day", ["event_type"], source="events_sales")}
SELECT event_type, "Date", round("Sales", 4) AS "Sales" FROM panel""")
def daily_events(spark, folder):
    return rounded(rollup.daily(star.events_daily(spark, folder), ("event_type",)), 4, "Sales")


@query("segment_series", f"""WITH {SALES},
stacked AS (SELECT 'Category' AS dimension, "Category" AS value, "Order Date", "Sales" FROM sales
            UNION ALL SELECT 'Region', "Region", "Order Date", "Sales" FROM sales),
{period_sql("month", ["dimension", "value"], source="stacked")}
SELECT dimension, value, "Date", round("Sales", 4) AS "Sales" FROM panel""")
def segment_series(spark, folder):
    return rounded(rollup.stack_dimensions(_lines(spark, folder, "Category", "Region"), ["Category", "Region"]), 4, "Sales")


def _bands_sql(keys: list[str], window: int, k: float, z: float, source: str = "panel") -> str:
    part = f"PARTITION BY {', '.join(chr(34) + x + chr(34) for x in keys)}" if keys else ""
    sizes = range(3, window + 1)

    def pick(fn: str) -> str:
        cases = " ".join(
            f'WHEN {s} THEN {fn}("Sales") OVER ({part} ORDER BY "Date" ROWS BETWEEN {s // 2} PRECEDING AND {(s - 1) // 2} FOLLOWING)'
            for s in sizes
        )
        return f"CASE size {cases} END"

    return f"""sized AS (
  SELECT *, greatest(3, least({window}, count(*) OVER ({part}) // 3)) AS size,
         avg("Sales") OVER ({part}) AS mu, stddev_samp("Sales") OVER ({part}) AS sd FROM {source}),
banded AS (
  SELECT *, ("Sales" - mu) / CASE WHEN sd = 0 THEN 1e-5 ELSE sd END AS "Z_Score",
         {pick('avg')} AS "Rolling_Mean", coalesce({pick('stddev_samp')}, 0.0) AS "Rolling_Std" FROM sized),
flagged AS (
  SELECT *, CASE WHEN abs("Z_Score") > {z} THEN 1 ELSE 0 END AS "Anomaly_Z",
         CASE WHEN "Sales" > "Rolling_Mean" + {k} * "Rolling_Std" OR "Sales" < "Rolling_Mean" - {k} * "Rolling_Std"
              THEN 1 ELSE 0 END AS "Anomaly_Rolling" FROM banded)"""


@query("statistical_flags", f"""WITH {SALES}, {period_sql("week", ["Region"])}, {_bands_sql(["Region"], 8, 2.0, 2.0)}
SELECT "Region", "Date", round("Sales", 4) AS "Sales", round("Z_Score", 6) AS "Z_Score",
       CAST("Anomaly_Z" AS INTEGER) AS "Anomaly_Z", round("Rolling_Mean", 7) AS "Rolling_Mean",
       round("Rolling_Std", 4) AS "Rolling_Std", CAST("Anomaly_Rolling" AS INTEGER) AS "Anomaly_Rolling" FROM flagged""")
def statistical_flags(spark, folder):
    out = anomaly.statistical_flags(_weekly(spark, folder, "Region"), ("Region",))
    out = rounded(rounded(out, 4, "Sales", "Rolling_Std"), 6, "Z_Score")
    return rounded(out, 7, "Rolling_Mean")


@query("short_series_bands", f"""WITH {EVENTS}, {period_sql("day", ["event_type"], source="events_sales")},
{_bands_sql(["event_type"], 24, 1.5, 1.5)}
SELECT event_type, "Date", round("Rolling_Mean", 7) AS "Rolling_Mean", round("Rolling_Std", 4) AS "Rolling_Std",
       CAST("Anomaly_Rolling" AS INTEGER) AS "Anomaly_Rolling" FROM flagged""")
def short_series_bands(spark, folder):
    # 31 days: the window asked for (24) falls to a third of the series
    panel = rollup.daily(star.events_daily(spark, folder), ("event_type",))
    out = windows.centred_bands(panel, ("event_type",), 24, 1.5)
    return rounded(rounded(out, 4, "Rolling_Std"), 7, "Rolling_Mean").drop("Sales")


@query("whole_series_z_scores", f"""WITH {SALES}, {period_sql("month", [])}
SELECT "Date", round(("Sales" - avg("Sales") OVER ()) / stddev_samp("Sales") OVER (), 6) AS "Z_Score" FROM panel""")
def whole_series_z_scores(spark, folder):
    return rounded(windows.z_scores(_monthly(spark, folder)).select("Date", "Z_Score"), 6, "Z_Score")


@query("lag_features", f"""WITH {SALES}, {period_sql("month", ["Category"])},
lags AS (SELECT *, lag("Sales", 1) OVER w AS lag_1, lag("Sales", 2) OVER w AS lag_2, lag("Sales", 3) OVER w AS lag_3
         FROM panel WINDOW w AS (PARTITION BY "Category" ORDER BY "Date"))
SELECT "Category", "Date", round("Sales", 4) AS "Sales", round(lag_1, 4) AS lag_1, round(lag_2, 4) AS lag_2,
       round(lag_3, 4) AS lag_3 FROM lags WHERE lag_3 IS NOT NULL""")
def lag_features(spark, folder):
    return rounded(windows.lagged(_monthly(spark, folder, "Category"), ("Category",)), 4, "Sales", "lag_1", "lag_2", "lag_3")


@query("first_difference", f"""WITH {SALES}, {period_sql("month", ["Region"])},
d AS (SELECT "Region", "Date", "Sales" - lag("Sales") OVER (PARTITION BY "Region" ORDER BY "Date") AS c FROM panel)
SELECT "Region", "Date", round(c, 4) AS "Sales" FROM d WHERE c IS NOT NULL""")
def first_difference(spark, folder):
    return rounded(windows.first_difference(_monthly(spark, folder, "Region"), ("Region",)), 4, "Sales")


@query("holdout_split", f"""WITH {SALES}, {period_sql("month", ["Region"])}
SELECT "Region", "Date", round("Sales", 4) AS "Sales",
       CASE WHEN row_number() OVER (PARTITION BY "Region" ORDER BY "Date" DESC) <= 3 THEN 'validation' ELSE 'train' END AS split
FROM panel""")
def holdout_split(spark, folder):
    return rounded(windows.holdout_split(_monthly(spark, folder, "Region"), ("Region",)), 4, "Sales")


@query("last_values", f"""WITH {SALES}, {period_sql("month", ["State"])},
r AS (SELECT *, row_number() OVER (PARTITION BY "State" ORDER BY "Date" DESC) AS recency FROM panel)
SELECT "State", "Date", round("Sales", 4) AS "Sales", CAST(recency AS INTEGER) AS recency FROM r WHERE recency <= 3""")
def last_values(spark, folder):
    return rounded(windows.last_values(_monthly(spark, folder, "State"), ("State",)), 4, "Sales")


@query("largest_weeks", f"""WITH {SALES}, {period_sql("week", [])}
SELECT "Date", round("Sales", 4) AS "Sales" FROM panel ORDER BY panel."Sales" DESC, "Date" LIMIT 10""")
def largest_weeks(spark, folder):
    return rounded(windows.top_rows(_weekly(spark, folder), 10), 4, "Sales")


@query("largest_weeks_per_region", f"""WITH {SALES}, {period_sql("week", ["Region"])},
r AS (SELECT *, row_number() OVER (PARTITION BY "Region" ORDER BY "Sales" DESC, "Date") AS k FROM panel)
SELECT "Region", "Date", round("Sales", 4) AS "Sales" FROM r WHERE k <= 5""")
def largest_weeks_per_region(spark, folder):
    return rounded(windows.top_rows(_weekly(spark, folder, "Region"), 5, keys=("Region",)), 4, "Sales")


@query("seasonal_decomposition", f"""WITH {SALES}, {period_sql("month", ["Region"])},
t AS (
  SELECT *, (row_number() OVER w - 1) % 12 AS phase,
         (0.5 * lag("Sales", 6) OVER w + sum("Sales") OVER (PARTITION BY "Region" ORDER BY "Date" ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
          + 0.5 * lead("Sales", 6) OVER w) / 12 AS trend
  FROM panel WINDOW w AS (PARTITION BY "Region" ORDER BY "Date")),
e AS (SELECT "Region", phase, avg("Sales" - trend) AS effect FROM t GROUP BY 1, 2),
c AS (SELECT *, effect - avg(effect) OVER (PARTITION BY "Region") AS seasonal FROM e)
SELECT t."Region", "Date", round("Sales", 4) AS "Sales", round(trend, 7) AS trend, round(seasonal, 2) AS seasonal,
       round("Sales" - trend - seasonal, 2) AS resid
FROM t JOIN c ON t."Region" = c."Region" AND t.phase = c.phase""")
def seasonal_decomposition(spark, folder):
    out = tsstats.decompose(_monthly(spark, folder, "Region"), ("Region",))
    return rounded(rounded(rounded(out, 4, "Sales"), 7, "trend"), 2, "seasonal", "resid")


@query("autocorrelation", f"""WITH {SALES}, {period_sql("month", ["Region"])},
c AS (SELECT "Region", row_number() OVER (PARTITION BY "Region" ORDER BY "Date") AS i,
             "Sales" - avg("Sales") OVER (PARTITION BY "Region") AS v FROM panel),
lags AS (SELECT unnest(generate_series(0, 15)) AS lag),
s AS (SELECT a."Region", lag, sum(a.v * b.v) AS s FROM c a JOIN lags ON true JOIN c b ON a."Region" = b."Region" AND b.i = a.i - lag
      GROUP BY 1, 2)
SELECT "Region", CAST(lag AS INTEGER) AS lag, round(s / first_value(s) OVER (PARTITION BY "Region" ORDER BY lag), 6) AS acf FROM s""")
def autocorrelation(spark, folder):
    return rounded(tsstats.autocorrelation(_monthly(spark, folder, "Region"), ("Region",)), 6, "acf")


_NAIVE_SQL = f"""WITH {SALES}, {period_sql("month", ["State"])},
r AS (SELECT *, row_number() OVER (PARTITION BY "State" ORDER BY "Date" DESC) AS back,
             lag("Sales", 12) OVER w AS year_ago, lag("Sales", 3) OVER w AS l3, lag("Sales", 2) OVER w AS l2,
             lag("Sales", 1) OVER w AS l1
      FROM panel WINDOW w AS (PARTITION BY "State" ORDER BY "Date")),
scored AS (
  SELECT "State", 'Seasonal' AS "Model", "Sales" AS actual, year_ago AS f FROM r WHERE back <= 3 UNION ALL
  SELECT "State", 'Last', "Sales", CASE back WHEN 1 THEN l3 WHEN 2 THEN l2 ELSE l1 END FROM r WHERE back <= 3),
metrics AS (
  SELECT "State", "Model", avg(abs(actual - f)) AS mae, sqrt(avg((actual - f) * (actual - f))) AS rmse,
         avg(abs(CASE WHEN actual = 0 THEN 1e-5 ELSE actual END - f) / abs(CASE WHEN actual = 0 THEN 1e-5 ELSE actual END)) AS mape
  FROM scored GROUP BY 1, 2),
ahead AS (
  SELECT "State", 'Seasonal' AS "Model", max(CASE back WHEN 12 THEN "Sales" END) AS m1,
         max(CASE back WHEN 11 THEN "Sales" END) AS m2, max(CASE back WHEN 10 THEN "Sales" END) AS m3 FROM r GROUP BY 1
  UNION ALL SELECT "State", 'Last', max(CASE back WHEN 1 THEN "Sales" END), max(CASE back WHEN 1 THEN "Sales" END),
         max(CASE back WHEN 1 THEN "Sales" END) FROM r GROUP BY 1)"""


def _naive_evaluation(spark, folder) -> DataFrame:
    """Two naive models in the layout of an evaluation: the value a year ago, and the last known value."""
    keys = ("State",)
    panel = _monthly(spark, folder, *keys)
    w = windows.ordered(keys)
    back = F.row_number().over(windows.ordered(keys, descending=True))
    rows = panel.withColumns({
        "back": back, "year_ago": F.lag("Sales", 12).over(w),
        **{f"l{i}": F.lag("Sales", i).over(w) for i in (1, 2, 3)},
    })
    last = F.when(F.col("back") == 1, F.col("l3")).when(F.col("back") == 2, F.col("l2")).otherwise(F.col("l1"))

    def row(model, split, step, actual, value):
        return F.struct(F.lit(model).alias("Model"), F.lit(split).alias("split"), step.cast("int").alias("step"),
                        actual.cast("double").alias("actual"), value.alias("Forecast"))

    step = 4 - F.col("back")
    none = F.lit(None)
    held = F.when(F.col("back") <= 3, F.array(
        row("Seasonal", "validation", step, F.col("Sales"), F.col("year_ago")),
        row("Last", "validation", step, F.col("Sales"), last)))
    ahead = F.when(F.col("back").between(10, 12), F.array(
        row("Seasonal", "future", 13 - F.col("back"), none, F.col("Sales"))))
    flat = F.when(F.col("back") == 1, F.array(*[row("Last", "future", F.lit(i), none, F.col("Sales")) for i in (1, 2, 3)]))
    empty = F.array().cast("array<struct<Model:string,split:string,step:int,actual:double,Forecast:double>>")
    parts = F.concat(*[F.coalesce(p, empty) for p in (held, ahead, flat)])
    return rows.select("State", F.explode(parts).alias("e")).select(
        "State", "e.*", F.lit(None).cast("string").alias("error")
    )


_NUMBERS = ["MAE", "RMSE", "Forecast Month 1", "Forecast Month 2", "Forecast Month 3"]


@query("naive_errors", _NAIVE_SQL + """
SELECT "State", "Model", round(mae, 4) AS "MAE", round(rmse, 4) AS "RMSE", round(mape, 3) AS "MAPE" FROM metrics""")
def naive_errors(spark, folder):
    scored = _naive_evaluation(spark, folder).where(F.col("split") == "validation")
    return rounded(rounded(kpi.error_metrics(scored, ("State", "Model")), 4, "MAE", "RMSE"), 3, "MAPE")


@query("naive_comparison", _NAIVE_SQL + """
SELECT "State", "Model", round(mae, 4) AS "MAE", round(rmse, 4) AS "RMSE", round(mape, 3) AS "MAPE",
       round(m1, 4) AS "Forecast Month 1", round(m2, 4) AS "Forecast Month 2", round(m3, 4) AS "Forecast Month 3"
FROM metrics JOIN ahead USING ("State", "Model")""")
def naive_comparison(spark, folder):
    out = models.comparison(_naive_evaluation(spark, folder), ("State",)).drop("error")
    return rounded(rounded(out, 4, *_NUMBERS), 3, "MAPE")


@query("best_naive_model", _NAIVE_SQL + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY "State" ORDER BY rmse, "Model") AS k FROM metrics)
SELECT "State", "Model", round(mae, 4) AS "MAE", round(rmse, 4) AS "RMSE", round(mape, 3) AS "MAPE" FROM ranked WHERE k = 1""")
def best_naive_model(spark, folder):
    out = models.best_models(models.comparison(_naive_evaluation(spark, folder), ("State",)), ("State",))
    return rounded(rounded(out, 4, "MAE", "RMSE"), 3, "MAPE")


@query("naive_drift", _NAIVE_SQL + """
SELECT "State", "Model", round(mape, 3) AS "MAPE" FROM metrics WHERE mape > 0.15""")
def naive_drift(spark, folder):
    compared = models.comparison(_naive_evaluation(spark, folder), ("State",))
    return rounded(models.needs_retraining(compared).select("State", "Model", "MAPE"), 3, "MAPE")


def _statistical_vote(spark, folder):
    """The two statistical detectors in the layout of the full vote, the forest abstaining."""
    flags = anomaly.statistical_flags(_weekly(spark, folder, "Region"), ("Region",))
    votes = F.col("Anomaly_Z") + F.col("Anomaly_Rolling")
    return flags.withColumns({
        "Anomaly_IForest": F.lit(0), "Anomaly_Vote_Count": votes, "Is_Anomaly": (votes >= 1).cast("int")})


@query("anomaly_kpis", f"""WITH {SALES}, {period_sql("week", ["Region"])}, {_bands_sql(["Region"], 8, 2.0, 2.0)},
v AS (SELECT *, CASE WHEN "Anomaly_Z" + "Anomaly_Rolling" >= 1 THEN 1 ELSE 0 END AS hit FROM flagged)
SELECT "Region", CAST(sum(hit) AS BIGINT) AS anomalies, round(avg(hit), 6) AS anomaly_ratio,
       round(coalesce(max(CASE WHEN hit = 1 THEN "Sales" END), 0.0), 4) AS max_spike,
       CAST(sum("Anomaly_Z") AS BIGINT) AS z_flags, CAST(sum("Anomaly_Rolling") AS BIGINT) AS rolling_flags,
       CAST(0 AS BIGINT) AS forest_flags FROM v GROUP BY 1""")
def anomaly_kpis(spark, folder):
    out = kpi.anomaly_kpis(_statistical_vote(spark, folder), ("Region",))
    return rounded(rounded(out, 6, "anomaly_ratio"), 4, "max_spike")


@query("anomaly_log", f"""WITH {SALES}, {period_sql("week", ["Region"])}, {_bands_sql(["Region"], 8, 2.0, 2.0)}
SELECT "Region", strftime("Date", '%Y-%m-%d') AS "Date", round("Sales", 4) AS "Sales ($)",
       round("Rolling_Mean", 7) AS "Local Average ($)", round("Z_Score", 6) AS "Z_Score",
       CAST("Anomaly_Z" + "Anomaly_Rolling" AS INTEGER) AS "Ensemble Vote Score (Max 3)"
FROM flagged WHERE "Anomaly_Z" + "Anomaly_Rolling" >= 1""")
def anomaly_log(spark, folder):
    out = anomaly.audit_log(_statistical_vote(spark, folder), ("Region",))
    return rounded(rounded(rounded(out, 4, "Sales ($)"), 7, "Local Average ($)"), 6, "Z_Score")


@query("winsorized_weeks", f"""WITH {SALES}, {period_sql("week", ["Region"])}, {_bands_sql(["Region"], 8, 2.0, 2.0)}
SELECT "Region", "Date", round(CASE WHEN "Anomaly_Z" = 1 THEN least("Sales", "Rolling_Mean" + 2.0 * "Rolling_Std")
       ELSE "Sales" END, 4) AS "Sales_Winsorized" FROM flagged""")
def winsorized_weeks(spark, folder):
    out = anomaly.winsorize_flagged(_statistical_vote(spark, folder), 2.0, "Anomaly_Z")
    return rounded(out.select("Region", "Date", "Sales_Winsorized"), 4, "Sales_Winsorized")

