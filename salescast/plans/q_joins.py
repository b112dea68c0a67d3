"""Queries for 2.4 (joins)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescast.operators import analytics as an
from salescast.operators import forecast as fc
from salescast.operators import joins, measures as me
from salescast.plans.catalog import query


@query("jn1_sales_by_city", """
SELECT s.city, SUM(t.sales) AS sales FROM train t LEFT JOIN stores s ON t.store_nbr = s.store_nbr GROUP BY s.city""")
def jn1_sales_by_city(ctx):
    """JN1: store attributes joined to the sales rows."""
    j = joins.join_stores(ctx.cleaned["train"], ctx.raw.stores)
    return j.groupBy("city").agg(F.sum("sales").alias("sales"))


@query("jn2_oil_coverage", """
SELECT COUNT(*) AS rows, COUNT(o.oil_price) AS with_oil, round(AVG(o.oil_price), 6) AS avg_oil
FROM train t LEFT JOIN oil o ON t.date = o.date""")
def jn2_oil_coverage(ctx):
    """JN2: every sales row finds a (filled) daily oil price."""
    j = joins.join_daily(ctx.cleaned["train"], ctx.cleaned["oil"])
    return j.agg(F.count(F.lit(1)).alias("rows"), F.count("oil_price").alias("with_oil"),
                  F.round(F.avg("oil_price"), 6).alias("avg_oil"))


@query("jn3_sales_by_holiday_flag", """
SELECT COALESCE(h.is_holiday, 0) AS is_holiday, SUM(t.sales) AS sales, COUNT(*) AS rows
FROM train t LEFT JOIN holidays h ON t.date = h.date GROUP BY 1""")
def jn3_sales_by_holiday_flag(ctx):
    """JN3: holiday flag joined, missing dates are 0."""
    j = joins.join_holidays(ctx.cleaned["train"], ctx.cleaned["holidays"])
    return j.groupBy("is_holiday").agg(F.sum("sales").alias("sales"), F.count(F.lit(1)).alias("rows"))


@query("jn4_transactions_by_store", """
SELECT t.store_nbr, SUM(COALESCE(CAST(x.transactions AS DOUBLE), 0.0)) AS transactions
FROM train t LEFT JOIN transactions x ON t.date = x.date AND t.store_nbr = x.store_nbr GROUP BY t.store_nbr""")
def jn4_transactions_by_store(ctx):
    """JN4: composite-key (date, store) left join."""
    j = joins.join_transactions(ctx.cleaned["train"], ctx.raw.transactions)
    return j.groupBy("store_nbr").agg(F.sum("transactions").alias("transactions"))


@query("jn5_revenue_by_city_category", """
SELECT city, category, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM sales_star GROUP BY city, category""")
def jn5_revenue_by_city_category(ctx):
    """JN5: fact left-joined with two dimensions."""
    return me.total(ctx.star, "revenue", ["city", "category"])


@query("jn6_inner_rows_by_category", """
SELECT p.category, COUNT(*) AS rows FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.category""")
def jn6_inner_rows_by_category(ctx):
    s = ctx.star
    j = joins.star_join(s.fact_sales, s.dim_product, "product_key", how="inner", cols=["category"])
    return j.groupBy("category").agg(F.count(F.lit(1)).alias("rows"))


@query("jn7_city_forecast", """
SELECT forecast_horizon, CAST(SUM(predicted_revenue) AS DOUBLE) AS forecast_revenue, SUM(predicted_sales) AS forecast_units
FROM fact_forecasts WHERE store_key IN (SELECT store_key FROM dim_store WHERE city = 'NATION_1')
GROUP BY forecast_horizon""")
def jn7_city_forecast(ctx):
    """JN7: forecasts of one city through a semi join with the store dim."""
    f = fc.filter_forecasts(ctx.forecast_star, "All", "NATION_1")
    return f.groupBy("forecast_horizon").agg(F.sum("predicted_revenue").cast("double").alias("forecast_revenue"),
                                              F.sum("predicted_sales").alias("forecast_units"))


@query("jn9_actual_vs_predicted_daily", """
SELECT a.date_key, a.actual, p.predicted FROM
(SELECT date_key, SUM(sales) AS actual FROM fact_sales GROUP BY date_key) a
JOIN (SELECT date_key, SUM(predicted_sales) AS predicted FROM bt_forecasts GROUP BY date_key) p
ON a.date_key = p.date_key""")
def jn9_actual_vs_predicted_daily(ctx):
    """JN9: daily actual and predicted totals, inner join on the day."""
    s = ctx.backtest_star
    a = s.fact_sales.groupBy("date_key").agg(F.sum("sales").alias("actual"))
    p = s.fact_forecasts.groupBy("date_key").agg(F.sum("predicted_sales").alias("predicted"))
    return a.join(p, "date_key")


@query("jn10_match_forecasts", """
SELECT f.date_key, f.store_key, f.product_key, f.sales, b.predicted
FROM fact_sales f JOIN (SELECT date_key, store_key, product_key, SUM(predicted_sales) AS predicted
                        FROM bt_forecasts GROUP BY ALL) b
ON f.date_key = b.date_key AND f.store_key = b.store_key AND f.product_key = b.product_key""")
def jn10_match_forecasts(ctx):
    """JN10: row match actual <-> forecast on (date, store, product)."""
    return me.match_forecasts(ctx.backtest_star)


@query("jn11_forecast_product_keys", """
SELECT product_key, COUNT(*) AS rows FROM fact_forecasts GROUP BY product_key""")
def jn11_forecast_product_keys(ctx):
    """JN11: family -> product_key surrogate lookup on the forecasts."""
    return ctx.forecast_star.fact_forecasts.groupBy("product_key").agg(F.count(F.lit(1)).alias("rows"))


@query("jn12_scoring_grid", """
SELECT COUNT(*) AS rows, COUNT(DISTINCT date) AS dates, COUNT(DISTINCT (store_nbr, family)) AS series,
       MIN(date) AS first_date, MAX(date) AS last_date FROM fc_frame""")
def jn12_scoring_grid(ctx):
    """JN12: horizon dates for every series (generator, no Cartesian join)."""
    f = fc.scoring_frame(ctx.star, ctx.features)
    return f.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("date").alias("dates"),
                 F.countDistinct("store_nbr", "family").alias("series"),
                 F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("jn13_scoring_store_attributes", """
SELECT DISTINCT store_nbr, store_key, city, state, type, cluster FROM fc_frame""")
def jn13_scoring_store_attributes(ctx):
    """JN13: grid store_nbr joined to dim_store.store_key (different names)."""
    f = fc.scoring_frame(ctx.star, ctx.features)
    return f.select("store_nbr", "store_key", "city", "state", "type", "cluster").distinct()


@query("jn8_orphan_report", """
SELECT 'date_key' AS key, COUNT(*) AS orphans FROM (SELECT DISTINCT date_key FROM fact_forecasts)
WHERE date_key NOT IN (SELECT date_key FROM dim_date)
UNION ALL
SELECT 'store_key', COUNT(*) FROM (SELECT DISTINCT store_key FROM fact_forecasts)
WHERE store_key NOT IN (SELECT store_key FROM dim_store)""")
def jn8_orphan_report(ctx):
    """JN8: anti joins of fact keys against dimensions."""
    s = ctx.forecast_star
    a = joins.orphan_keys(s.fact_forecasts, s.dim_date, "date_key").agg(F.count(F.lit(1)).alias("orphans"))
    b = joins.orphan_keys(s.fact_forecasts, s.dim_store, "store_key").agg(F.count(F.lit(1)).alias("orphans"))
    return (a.select(F.lit("date_key").alias("key"), "orphans")
             .unionByName(b.select(F.lit("store_key").alias("key"), "orphans")))


@query("fc10_timeline", """
SELECT date_key, CAST(SUM(revenue) AS DOUBLE) AS revenue, 'Actual' AS data_source,
       CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS date,
       (SELECT MIN(date) FROM fact_forecasts) AS forecast_start
FROM fact_sales GROUP BY date_key
UNION ALL
SELECT date_key, CAST(SUM(predicted_revenue) AS DOUBLE), 'Forecast',
       CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE), (SELECT MIN(date) FROM fact_forecasts)
FROM fact_forecasts GROUP BY date_key""")
def fc10_timeline(ctx):
    """FC10 / ST-U: actual and forecast daily revenue on one axis."""
    t = fc.timeline(ctx.forecast_star)
    return t.withColumn("revenue", F.col("revenue").cast("double")).select(
        "date_key", "revenue", "data_source", "date", "forecast_start")


@query("ag15_horizon_counts", "SELECT forecast_horizon, COUNT(*) AS rows FROM fact_forecasts GROUP BY 1")
def ag15_horizon_counts(ctx):
    """AG15 / FC9: rows per forecast horizon (31 / 30 / 29 days, Q8)."""
    return fc.horizon_breakdown(ctx.forecast_star.fact_forecasts)


@query("ag2_daily_units_all_sources", """
SELECT date_key, SUM(sales) AS units FROM (
  SELECT date_key, sales FROM fact_sales UNION ALL SELECT date_key, predicted_sales FROM fact_forecasts)
GROUP BY date_key""")
def ag2_daily_units_all_sources(ctx):
    """AG2 over the union of actuals and forecasts."""
    u = an.actuals_and_forecasts(ctx.forecast_star)
    return u.groupBy("date_key").agg(F.sum("sales").alias("units"))
