"""Queries for 2.11 (BI measures) and 2.12 (row-level security)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescast.functions import calendar as cal
from salescast.functions import fixed
from salescast.operators import analytics as an
from salescast.operators import measures as me, security as sec
from salescast.operators import star as starmod
from salescast.plans.catalog import query
from salescast.plans.oracle_base import date_key_sql

YEAR = 2000


@query("me1_total_revenue_by_region", """
SELECT region, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM sales_star GROUP BY region""")
def me1_total_revenue_by_region(ctx):
    return me.total(ctx.star, "revenue", ["region"])


@query("me2_total_units_by_category", """
SELECT category, SUM(sales) AS units FROM sales_star GROUP BY category""")
def me2_total_units_by_category(ctx):
    return me.total(ctx.star, "units", ["category"])


@query("me3_total_margin_by_store_type_year", """
SELECT store_type, d_year AS year, CAST(SUM(margin) AS DOUBLE) AS margin FROM sales_star
GROUP BY store_type, d_year""")
def me3_total_margin_by_store_type_year(ctx):
    return me.total(ctx.star, "margin", ["store_type", "year"])


YOY_MONTH_SQL = """
WITH cur AS (SELECT d_year AS year, d_month AS month, SUM(revenue) AS cur FROM sales_star GROUP BY 1, 2),
prev AS (SELECT year + 1 AS year, month, cur AS prev FROM cur),
spine AS (SELECT DISTINCT year, month FROM dim_date)
SELECT s.year, s.month, CAST(cur AS DOUBLE) AS current, CAST(prev AS DOUBLE) AS prior_year,
       round(CAST(COALESCE(cur, 0) - prev AS DOUBLE) / NULLIF(CAST(prev AS DOUBLE), 0), 6) AS yoy_growth
FROM spine s LEFT JOIN cur c ON s.year = c.year AND s.month = c.month
LEFT JOIN prev p ON s.year = p.year AND s.month = p.month"""


@query("me4_yoy_month", YOY_MONTH_SQL)
def me4_yoy_month(ctx):
    """ME4 / WN11: month-grain year-over-year growth."""
    return me.yoy(ctx.star, "month")


@query("me4_yoy_year_by_category", """
WITH cur AS (SELECT d_year AS year, category, SUM(revenue) AS cur FROM sales_star GROUP BY 1, 2),
prev AS (SELECT year + 1 AS year, category, cur AS prev FROM cur),
rows AS (SELECT year, category FROM cur UNION SELECT year, category FROM prev)
SELECT r.year, r.category, CAST(cur AS DOUBLE) AS current, CAST(prev AS DOUBLE) AS prior_year,
       round(CAST(COALESCE(cur, 0) - prev AS DOUBLE) / NULLIF(CAST(prev AS DOUBLE), 0), 6) AS yoy_growth
FROM rows r LEFT JOIN cur c ON r.year = c.year AND r.category = c.category
LEFT JOIN prev p ON r.year = p.year AND r.category = p.category
WHERE r.year IN (SELECT year FROM dim_date)""")
def me4_yoy_year_by_category(ctx):
    return me.yoy(ctx.star, "year", ["category"])


@query("me4_yoy_date", """
WITH cur AS (SELECT date, SUM(revenue) AS cur FROM fact_sales GROUP BY date),
prev AS (SELECT d.date, c.cur AS prev FROM dim_date d
         JOIN cur c ON c.date = CAST(d.date - INTERVAL 12 MONTH AS DATE))
SELECT d.date, CAST(cur AS DOUBLE) AS current, CAST(prev AS DOUBLE) AS prior_year,
       round(CAST(COALESCE(cur, 0) - prev AS DOUBLE) / NULLIF(CAST(prev AS DOUBLE), 0), 6) AS yoy_growth
FROM dim_date d LEFT JOIN cur c ON d.date = c.date LEFT JOIN prev p ON d.date = p.date""")
def me4_yoy_date(ctx):
    """ME4 at day grain: 29 Feb and 28 Feb of a leap year both compare with
    28 Feb a year earlier."""
    return me.yoy(ctx.star, "date")


@query("me5_revenue_ytd", """
SELECT d.date, CAST(SUM(v) OVER (PARTITION BY year(d.date) ORDER BY d.date_key
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_ytd
FROM dim_date d LEFT JOIN (SELECT date_key, SUM(revenue) AS v FROM fact_sales GROUP BY date_key) f
ON d.date_key = f.date_key""")
def me5_revenue_ytd(ctx):
    """ME5 / WN9: year-to-date running revenue for every calendar day."""
    return me.to_date_total(ctx.star, "year")


@query("me6_revenue_mtd", """
SELECT d.date, CAST(SUM(v) OVER (PARTITION BY year(d.date), month(d.date) ORDER BY d.date_key
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_mtd
FROM dim_date d LEFT JOIN (SELECT date_key, SUM(revenue) AS v FROM fact_sales GROUP BY date_key) f
ON d.date_key = f.date_key""")
def me6_revenue_mtd(ctx):
    """ME6 / WN10: month-to-date running revenue."""
    return me.to_date_total(ctx.star, "month")


@query("me5_revenue_ytd_by_region", """
SELECT CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS date, region,
       CAST(SUM(v) OVER (PARTITION BY date_key // 10000, region ORDER BY date_key
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_ytd
FROM (SELECT date_key, region, SUM(revenue) AS v FROM sales_star GROUP BY date_key, region)""")
def me5_revenue_ytd_by_region(ctx):
    return me.to_date_total(ctx.star, "year", ["region"])


BT_STAR = """
bt_match AS (
  SELECT f.date_key, f.store_key, f.product_key, f.sales, b.predicted
  FROM fact_sales f JOIN (SELECT date_key, store_key, product_key, SUM(predicted_sales) AS predicted
                          FROM bt_forecasts GROUP BY ALL) b
  ON f.date_key = b.date_key AND f.store_key = b.store_key AND f.product_key = b.product_key)"""


@query("me7_mape_by_category", """
SELECT p.category, round(SUM(CASE WHEN abs(sales) = 0 THEN NULL ELSE abs(sales - predicted) / abs(sales) END)
       / COUNT(*) * 100, 6) AS mape, COUNT(*) AS matched_rows
FROM bt_match m LEFT JOIN dim_product p ON m.product_key = p.product_key GROUP BY p.category""", ctes=BT_STAR)
def me7_mape_by_category(ctx):
    """ME7 / JN10: BI-style MAPE of the holdout forecast by category."""
    return me.mape_bi(ctx.backtest_star, ["category"])


@query("me7_mape_total", """
SELECT round(SUM(CASE WHEN abs(sales) = 0 THEN NULL ELSE abs(sales - predicted) / abs(sales) END)
       / NULLIF(COUNT(*), 0) * 100, 6) AS mape, COUNT(*) AS matched_rows FROM bt_match""", ctes=BT_STAR)
def me7_mape_total(ctx):
    return me.mape_bi(ctx.backtest_star)


@query("me7_mape_no_overlap", """
SELECT round(SUM(abs(f.sales - b.predicted_sales) / NULLIF(abs(f.sales), 0)) / NULLIF(COUNT(*), 0) * 100, 6) AS mape,
       COUNT(*) AS matched_rows
FROM fact_sales f JOIN fact_forecasts b ON f.date_key = b.date_key AND f.store_key = b.store_key
AND f.product_key = b.product_key""")
def me7_mape_no_overlap(ctx):
    """ME7 when forecasts lie after the actuals: nothing matches -> NULL."""
    return me.mape_bi(ctx.forecast_star)


@query("me8_pct_of_total_by_category", """
SELECT category, CAST(SUM(revenue) AS DOUBLE) AS revenue,
       round(CAST(SUM(revenue) AS DOUBLE) / (SELECT CAST(SUM(revenue) AS DOUBLE) FROM fact_sales), 6) AS pct_of_total
FROM sales_star GROUP BY category""")
def me8_pct_of_total_by_category(ctx):
    """ME8 / WN12."""
    return me.pct_of_total(ctx.star, ["category"])


@query("me8_pct_of_total_coastal_slicer", """
SELECT category, CAST(SUM(revenue) AS DOUBLE) AS revenue,
       round(CAST(SUM(revenue) AS DOUBLE) / (SELECT CAST(SUM(revenue) AS DOUBLE) FROM fact_sales), 6) AS pct_of_total
FROM sales_star WHERE region = 'Coastal' GROUP BY category""")
def me8_pct_of_total_coastal_slicer(ctx):
    """ME8 under a region slicer: the denominator ignores the slicer (Q13)."""
    return me.pct_of_total(ctx.star, ["category"], where={"dim_store": F.col("region") == "Coastal"})


@query("me9_pct_of_category_by_family", """
SELECT category, family, CAST(v AS DOUBLE) AS revenue,
       round(CAST(v AS DOUBLE) / CAST(SUM(v) OVER (PARTITION BY category) AS DOUBLE), 6) AS pct_of_category
FROM (SELECT category, family, SUM(revenue) AS v FROM sales_star GROUP BY category, family)""")
def me9_pct_of_category_by_family(ctx):
    """ME9 / WN13."""
    return me.pct_of_category(ctx.star, ["family"])


@query("me10_selected_metric", """
SELECT m.metric, category,
       CASE m.metric WHEN 'Units' THEN SUM(sales) WHEN 'Margin' THEN CAST(SUM(margin) AS DOUBLE)
                     ELSE CAST(SUM(revenue) AS DOUBLE) END AS selected_metric
FROM sales_star, (VALUES ('Revenue'), ('Units'), ('Margin'), ('(none)')) m(metric)
GROUP BY m.metric, category""")
def me10_selected_metric(ctx):
    """ME10 / ME11: each selector value (and no selection -> Revenue), one pass."""
    return me.selected_metric_table(ctx.star, ["category"])


@query("me12_forecast_revenue_by_region", """
SELECT region, CAST(SUM(predicted_revenue) AS DOUBLE) AS forecast_revenue FROM fc_star GROUP BY region""")
def me12_forecast_revenue_by_region(ctx):
    return me.total(ctx.forecast_star, "forecast_revenue", ["region"])


@query("me13_forecast_units_by_category", """
SELECT category, SUM(predicted_sales) AS forecast_units FROM fc_star GROUP BY category""")
def me13_forecast_units_by_category(ctx):
    return me.total(ctx.forecast_star, "forecast_units", ["category"])


@query("me14_forecast_variance_by_category", """
SELECT COALESCE(a.category, f.category) AS category, CAST(a.a AS DOUBLE) AS actual_revenue,
       CAST(f.f AS DOUBLE) AS forecast_revenue,
       round(CAST(COALESCE(f.f, 0) - a.a AS DOUBLE) / NULLIF(CAST(a.a AS DOUBLE), 0), 6) AS variance
FROM (SELECT category, SUM(revenue) AS a FROM sales_star GROUP BY category) a
FULL JOIN (SELECT category, SUM(predicted_revenue) AS f FROM fc_star GROUP BY category) f
ON a.category = f.category""")
def me14_forecast_variance_by_category(ctx):
    return me.forecast_variance(ctx.forecast_star, ["category"])


@query("me15_selected_forecast_metric", """
SELECT category, SUM(predicted_sales) AS selected_metric FROM fc_star GROUP BY category""")
def me15_selected_forecast_metric(ctx):
    return me.selected_metric(ctx.forecast_star, "Units", ["category"], forecast=True)


@query("me16_yoy_colour", f"""
SELECT *, CASE WHEN yoy_growth > 0.05 THEN '{fixed.YOY_GREEN}' WHEN yoy_growth < -0.05 THEN '{fixed.YOY_RED}'
          ELSE '{fixed.YOY_GREY}' END AS yoy_colour FROM ({YOY_MONTH_SQL})""")
def me16_yoy_colour(ctx):
    return me.yoy_colour(me.yoy(ctx.star, "month"))


@query("me17_mape_status", """
SELECT *, CASE WHEN COALESCE(mape, 0) <= 10 THEN 'Excellent' WHEN COALESCE(mape, 0) <= 20 THEN 'Good'
          WHEN COALESCE(mape, 0) <= 30 THEN 'Acceptable' ELSE 'Needs Improvement' END AS mape_status
FROM (SELECT p.category, round(SUM(CASE WHEN abs(sales) = 0 THEN NULL ELSE abs(sales - predicted) / abs(sales) END)
       / COUNT(*) * 100, 6) AS mape, COUNT(*) AS matched_rows
      FROM bt_match m LEFT JOIN dim_product p ON m.product_key = p.product_key GROUP BY p.category)""", ctes=BT_STAR)
def me17_mape_status(ctx):
    return me.mape_status(me.mape_bi(ctx.backtest_star, ["category"]), blank_as_zero=True)


@query("me17_mape_status_blank", """
SELECT mape, matched_rows,
       CASE WHEN mape IS NULL THEN NULL WHEN mape <= 10 THEN 'Excellent' WHEN mape <= 20 THEN 'Good'
            WHEN mape <= 30 THEN 'Acceptable' ELSE 'Needs Improvement' END AS mape_status,
       CASE WHEN COALESCE(mape, 0) <= 10 THEN 'Excellent' WHEN COALESCE(mape, 0) <= 20 THEN 'Good'
            WHEN COALESCE(mape, 0) <= 30 THEN 'Acceptable' ELSE 'Needs Improvement' END AS mape_status_bi
FROM (SELECT round(SUM(abs(f.sales - b.predicted_sales) / NULLIF(abs(f.sales), 0)) / NULLIF(COUNT(*), 0) * 100, 6)
             AS mape, COUNT(*) AS matched_rows
      FROM fact_sales f JOIN fact_forecasts b ON f.date_key = b.date_key AND f.store_key = b.store_key
      AND f.product_key = b.product_key)""")
def me17_mape_status_blank(ctx):
    """ME17 with a BLANK MAPE (forecasts after the actuals): NULL status by
    default, "Excellent" under the BI rule that BLANK compares as 0."""
    m = me.mape_bi(ctx.forecast_star)
    return m.select("mape", "matched_rows", cal.mape_status("mape").alias("mape_status"),
                    cal.mape_status("mape", blank_as_zero=True).alias("mape_status_bi"))


@query("me18_revenue_per_transaction", """
SELECT region, round(CAST(SUM(revenue) AS DOUBLE) / NULLIF(SUM(transactions), 0), 6) AS revenue_per_transaction
FROM sales_star GROUP BY region""")
def me18_revenue_per_transaction(ctx):
    """ME18 as written (transactions repeat on every product row, Q7)."""
    return me.revenue_per_transaction(ctx.star, ["region"])


@query("me18_revenue_per_transaction_dedup", """
SELECT r.region, round(CAST(r.r AS DOUBLE) / NULLIF(t.t, 0), 6) AS revenue_per_transaction
FROM (SELECT region, SUM(revenue) AS r FROM sales_star GROUP BY region) r
JOIN (SELECT region, SUM(t) AS t FROM (SELECT date_key, store_key, region, MAX(transactions) AS t
      FROM sales_star GROUP BY date_key, store_key, region) GROUP BY region) t ON r.region = t.region""")
def me18_revenue_per_transaction_dedup(ctx):
    return me.revenue_per_transaction(ctx.star, ["region"], dedup=True)


@query("me19_matrix_check_2001", """
WITH ext AS (SELECT CAST(UNNEST(generate_series(CAST(lo AS TIMESTAMP), CAST(hi + 90 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
             FROM (SELECT MIN(date) AS lo, MAX(date) AS hi FROM features)),
keys AS (SELECT """ + date_key_sql("d") + """ AS date_key FROM ext WHERE year(d) = 2001),
a AS (SELECT family, SUM(revenue) AS a FROM sales_star WHERE date_key IN (SELECT date_key FROM keys) GROUP BY family),
f AS (SELECT family, SUM(predicted_revenue) AS f FROM fc_star WHERE date_key IN (SELECT date_key FROM keys) GROUP BY family)
SELECT COALESCE(a.family, f.family) AS family, CAST(a AS DOUBLE) AS actual_revenue, CAST(f AS DOUBLE) AS forecast_revenue
FROM a FULL JOIN f ON a.family = f.family""")
def me19_matrix_check_2001(ctx):
    """ME19: family × (actual, forecast revenue) under a year filter; the
    calendar is extended by the forecast horizon so forecasts are reachable."""
    s = ctx.forecast_star.replace(dim_date=starmod.build_dim_date(ctx.features, fixed.FORECAST_HORIZON_DAYS))
    return me.matrix_check(s, 2001, "family")


# --- 2.12 row-level security ---------------------------------------------------
def _secured_kpis(star, label):
    return an.kpis(star).select(F.lit(label).alias("role"), "*")


@query("rl1_role_kpis", """
SELECT region AS role, CAST(SUM(revenue) AS DOUBLE) AS total_revenue, SUM(sales) AS total_units,
       (SELECT CAST(SUM(predicted_revenue) AS DOUBLE) FROM fc_star f WHERE f.region = s.region) AS forecast_revenue,
       (SELECT SUM(predicted_sales) FROM fc_star f WHERE f.region = s.region) AS forecast_units,
       (SELECT CAST(SUM(predicted_margin) AS DOUBLE) FROM fc_star f WHERE f.region = s.region) AS forecast_margin
FROM sales_star s WHERE region IN ('Highland', 'Coastal', 'Amazon') GROUP BY region""")
def rl1_role_kpis(ctx):
    """RL1: KPIs as each regional role sees them (filter on dim_store,
    propagated to both facts) — one grouped pass per fact."""
    return sec.role_kpis(ctx.forecast_star)


@query("rl2_all_regions_kpis", """
SELECT 'All' AS role, CAST(SUM(revenue) AS DOUBLE) AS total_revenue, SUM(sales) AS total_units,
       (SELECT CAST(SUM(predicted_revenue) AS DOUBLE) FROM fact_forecasts) AS forecast_revenue,
       (SELECT SUM(predicted_sales) FROM fact_forecasts) AS forecast_units,
       (SELECT CAST(SUM(predicted_margin) AS DOUBLE) FROM fact_forecasts) AS forecast_margin
FROM fact_sales""")
def rl2_all_regions_kpis(ctx):
    return _secured_kpis(sec.secure(ctx.forecast_star, "All"), "All")


GRANTS = [("ana", "Highland"), ("ana", "Coastal"), ("bo", "All"), ("cy", "Amazon"), ("cy", "Amazon")]
USERS = ["ana", "bo", "cy", "dee"]


@query("rl3_user_revenue", """
WITH g(u, role) AS (VALUES ('ana', 'Highland'), ('ana', 'Coastal'), ('bo', 'All'), ('cy', 'Amazon'), ('cy', 'Amazon')),
r(role, region) AS (VALUES ('Highland', 'Highland'), ('Coastal', 'Coastal'), ('Amazon', 'Amazon'), ('All', NULL)),
users(u) AS (VALUES ('ana'), ('bo'), ('cy'), ('dee')),
allowed AS (SELECT DISTINCT users.u, s.store_key FROM users JOIN g ON users.u = g.u JOIN r ON g.role = r.role
            JOIN dim_store s ON r.region IS NULL OR s.region = r.region)
SELECT users.u AS "user",
       (SELECT CAST(SUM(revenue) AS DOUBLE) FROM fact_sales f WHERE f.store_key IN (SELECT store_key FROM allowed a WHERE a.u = users.u)) AS revenue,
       (SELECT CAST(SUM(predicted_revenue) AS DOUBLE) FROM fact_forecasts f WHERE f.store_key IN (SELECT store_key FROM allowed a WHERE a.u = users.u)) AS forecast_revenue,
       (SELECT COUNT(*) FROM dim_store s WHERE s.store_key IN (SELECT store_key FROM allowed a WHERE a.u = users.u)) AS stores
FROM users""")
def rl3_user_revenue(ctx):
    """RL3: users mapped to roles; a user in two roles sees both regions,
    "All" sees everything, an unmapped user sees nothing (NULL sums)."""
    spark = ctx.spark
    grants = spark.createDataFrame(GRANTS, "user string, role string")
    roles = sec.roles_frame(spark)
    users = spark.createDataFrame([(u,) for u in USERS], "user string")
    return sec.user_totals(ctx.forecast_star, users, grants, roles)


@query("rl4_stores_by_region", "SELECT region, COUNT(*) AS stores FROM dim_store GROUP BY region")
def rl4_stores_by_region(ctx):
    return sec.stores_by_region(ctx.star.dim_store)


@query("jn14_context_highland_2000", """
SELECT category, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM sales_star
WHERE region = 'Highland' AND d_year = 2000 GROUP BY category""")
def jn14_context_highland_2000(ctx):
    """JN14: two dimension filters propagated to the fact by semi joins."""
    return me.total(ctx.star, "revenue", ["category"],
                    where={"dim_store": F.col("region") == "Highland", "dim_date": F.col("year") == YEAR})
