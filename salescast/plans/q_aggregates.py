"""Queries for 2.5 (aggregations) and 2.7 (sort / limit / set operations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescast.operators import analytics as an
from salescast.operators import forecast as fc
from salescast.operators import joins, measures as me
from salescast.plans.catalog import query

FC_SUMS = """(SELECT CAST(SUM(predicted_revenue) AS DOUBLE) FROM fact_forecasts) AS forecast_revenue,
       (SELECT SUM(predicted_sales) FROM fact_forecasts) AS forecast_units,
       (SELECT CAST(SUM(predicted_margin) AS DOUBLE) FROM fact_forecasts) AS forecast_margin"""


@query("ag1_kpis", f"""
SELECT CAST(SUM(revenue) AS DOUBLE) AS total_revenue, SUM(sales) AS total_units, {FC_SUMS}
FROM fact_sales""")
def ag1_kpis(ctx):
    return an.kpis(ctx.forecast_star)


@query("ag2_daily_revenue", """
SELECT date_key, CAST(SUM(revenue) AS DOUBLE) AS revenue,
       CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS date
FROM fact_sales GROUP BY date_key""")
def ag2_daily_revenue(ctx):
    d = an.daily_totals(ctx.star.fact_sales.select("date_key", "revenue"), "revenue")
    return d.withColumn("revenue", F.col("revenue").cast("double"))


@query("ag3_daily_forecast", """
SELECT date_key, CAST(SUM(predicted_revenue) AS DOUBLE) AS revenue, SUM(predicted_sales) AS units,
       CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS date
FROM fact_forecasts GROUP BY date_key""")
def ag3_daily_forecast(ctx):
    d = fc.explore_daily(ctx.forecast_star.fact_forecasts)
    return d.withColumn("revenue", F.col("revenue").cast("double")).select("date_key", "revenue", "units", "date")


@query("ag4_revenue_by_category", """
SELECT category, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM sales_star GROUP BY category""")
def ag4_revenue_by_category(ctx):
    return an.by_dim(ctx.star, "category")


@query("ag5_revenue_by_store_type", """
SELECT store_type, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM sales_star GROUP BY store_type""")
def ag5_revenue_by_store_type(ctx):
    return an.by_dim(ctx.star, "store_type")


@query("ag6_forecast_by_category", """
SELECT category, CAST(SUM(predicted_revenue) AS DOUBLE) AS predicted_revenue FROM fc_star GROUP BY category""")
def ag6_forecast_by_category(ctx):
    return an.by_dim(ctx.forecast_star, "category", "forecast")


@query("ag7_family_profile", """
SELECT family, SUM(sales) AS total, round(AVG(sales), 6) AS mean, round(stddev_samp(sales), 6) AS std
FROM features GROUP BY family""")
def ag7_family_profile(ctx):
    return an.profile_by(ctx.features, "family", "sales")


@query("ag8_mean_by_store_type", """
SELECT type, round(AVG(sales), 6) AS mean FROM features GROUP BY type""")
def ag8_mean_by_store_type(ctx):
    return an.mean_by(ctx.features, "type", "sales")


@query("ag8_top10_states_by_mean", """
SELECT state, round(AVG(sales), 6) AS avg_sales FROM features GROUP BY state
ORDER BY avg_sales DESC, state LIMIT 10""")
def ag8_top10_states_by_mean(ctx):
    """AG8 / SL2: top 10 states by mean sales."""
    return an.top_k(ctx.features, "state", "sales", 10, "avg")


@query("ag9_weekday_profile", """
SELECT CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, round(AVG(sales), 6) AS mean_sales
FROM train GROUP BY 1""")
def ag9_weekday_profile(ctx):
    return an.seasonal_profile(ctx.cleaned["train"], "day_of_week")


@query("ag9_month_profile", """
SELECT CAST(month(date) AS INTEGER) AS month, round(AVG(sales), 6) AS mean_sales FROM train GROUP BY 1""")
def ag9_month_profile(ctx):
    return an.seasonal_profile(ctx.cleaned["train"], "month")


@query("ag10_avg_transactions", """
SELECT store_nbr, day_of_week, round(AVG(transactions), 6) AS avg_transactions
FROM features GROUP BY store_nbr, day_of_week""")
def ag10_avg_transactions(ctx):
    return an.avg_transactions(ctx.features)


@query("ag13_avg_daily_forecast", """
SELECT round(CAST(SUM(d) AS DOUBLE) / COUNT(*), 6) AS avg_daily_predicted_revenue
FROM (SELECT date_key, SUM(predicted_revenue) AS d FROM fact_forecasts GROUP BY date_key)""")
def ag13_avg_daily_forecast(ctx):
    return an.avg_daily(ctx.forecast_star.fact_forecasts, "predicted_revenue")


@query("ag14_distinct_counts", f"""
SELECT COUNT(DISTINCT store_nbr) AS n_store_nbr, COUNT(DISTINCT family) AS n_family,
       COUNT(DISTINCT city) AS n_city, COUNT(DISTINCT state) AS n_state,
       (SELECT COUNT(DISTINCT category) FROM dim_product) AS n_category
FROM features""")
def ag14_distinct_counts(ctx):
    d = an.distinct_counts(ctx.features, ["store_nbr", "family", "city", "state"])
    ncat = ctx.star.dim_product.agg(F.countDistinct("category")).scalar()
    return d.select("*", ncat.alias("n_category"))


@query("ag15_region_counts", "SELECT region, COUNT(*) AS count FROM dim_store GROUP BY region")
def ag15_region_counts(ctx):
    return an.value_counts(ctx.star.dim_store, "region")


@query("ag16_city_slicer", "SELECT DISTINCT city FROM dim_store")
def ag16_city_slicer(ctx):
    return an.slicer_values(ctx.star.dim_store, "city")


@query("ag17_corr_sales_oil", """
SELECT round(corr(d.sales, o.dcoilwtico), 6) AS corr_sales_oil_price
FROM (SELECT date, SUM(sales) AS sales FROM train GROUP BY date) d
LEFT JOIN oil_raw o ON d.date = o.date""")
def ag17_corr_sales_oil(ctx):
    daily = an.daily_sales_vs_oil(ctx.cleaned["train"], ctx.raw.oil)
    return an.corr(daily, "sales", "oil_price")


@query("ag18_holiday_effect", """
WITH d AS (SELECT date, SUM(sales) AS sales FROM train GROUP BY date),
h AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders
      WHERE (day(o_orderdate) = 1 OR (month(o_orderdate) = 12 AND day(o_orderdate) = 25))
        AND NOT (o_orderpriority = '5-LOW')),
m AS (SELECT AVG(CASE WHEN h.date IS NOT NULL THEN d.sales END) AS hm,
             AVG(CASE WHEN h.date IS NULL THEN d.sales END) AS rm
      FROM d LEFT JOIN h ON d.date = h.date)
SELECT round(hm, 6) AS holiday_mean, round(rm, 6) AS regular_mean,
       round((hm / NULLIF(rm, 0) - 1) * 100, 6) AS pct_diff FROM m""")
def ag18_holiday_effect(ctx):
    return an.holiday_effect(ctx.cleaned["train"], ctx.raw.holidays)


@query("ag19_top5_family_share", """
WITH per AS (SELECT family, SUM(sales) AS v FROM features GROUP BY family)
SELECT round((SELECT SUM(v) FROM (SELECT v FROM per ORDER BY v DESC, family LIMIT 5)) / (SELECT SUM(v) FROM per), 6)
       AS top5_share""")
def ag19_top5_family_share(ctx):
    return an.top_share(ctx.features, "family", "sales", 5)


DESCRIBE_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS "column", COUNT({c}) AS count, round(AVG(CAST({c} AS DOUBLE)), 6) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, MIN(CAST({c} AS DOUBLE)) AS min,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, MAX(CAST({c} AS DOUBLE)) AS max
FROM features""" for c in ["sales", "onpromotion", "transactions", "oil_price"])


@query("ag20_describe", DESCRIBE_SQL)
def ag20_describe(ctx):
    return an.describe(ctx.features, ["sales", "onpromotion", "transactions", "oil_price"])


@query("ag22_min_max", """
SELECT MIN(date) AS min_date, MAX(date) AS max_date, MIN(sales) AS min_sales, MAX(sales) AS max_sales,
       MIN(oil_price) AS min_oil_price, MAX(oil_price) AS max_oil_price FROM features""")
def ag22_min_max(ctx):
    return an.min_max(ctx.features, ["date", "sales", "oil_price"])


@query("ag23_prediction_summary", """
SELECT round(AVG(predicted_sales), 6) AS mean, median(predicted_sales) AS median,
       MIN(predicted_sales) AS min, MAX(predicted_sales) AS max FROM fact_forecasts""")
def ag23_prediction_summary(ctx):
    return an.prediction_summary(ctx.forecast_star.fact_forecasts, "predicted_sales")


# --- 2.7 ----------------------------------------------------------------------
@query("sl2_top15_families", """
SELECT family, SUM(sales) AS sum_sales FROM features GROUP BY family
ORDER BY sum_sales DESC, family LIMIT 15""")
def sl2_top15_families(ctx):
    return an.top_k(ctx.features, "family", "sales", 15)


@query("sl3_top10_cities_forecast", """
SELECT city, CAST(SUM(predicted_revenue) AS DOUBLE) AS forecast_revenue FROM fc_star GROUP BY city
ORDER BY forecast_revenue DESC, city LIMIT 10""")
def sl3_top10_cities_forecast(ctx):
    s = ctx.forecast_star
    j = joins.star_join(s.fact_forecasts, s.dim_store, "store_key", cols=["city"])
    return (j.groupBy("city").agg(F.sum("predicted_revenue").cast("double").alias("forecast_revenue"))
             .orderBy(F.desc("forecast_revenue"), "city").limit(10))


@query("sl4_top10_families_revenue", """
SELECT family, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM sales_star GROUP BY family
ORDER BY revenue DESC, family LIMIT 10""")
def sl4_top10_families_revenue(ctx):
    s = ctx.star
    j = joins.star_join(s.fact_sales, s.dim_product, "product_key", cols=["family"])
    return (j.groupBy("family").agg(F.sum("revenue").cast("double").alias("revenue"))
             .orderBy(F.desc("revenue"), "family").limit(10))


@query("sl5_monthly_trend_2000", """
SELECT d_month AS month, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM sales_star
WHERE d_year = 2000 GROUP BY d_month""")
def sl5_monthly_trend_2000(ctx):
    t = me.total(ctx.star, "revenue", ["month"], where={"dim_date": F.col("year") == 2000})
    return t.select("month", "revenue")


@query("sl6_forecast_by_city", """
SELECT city, CAST(SUM(predicted_revenue) AS DOUBLE) AS forecast_revenue FROM fc_star GROUP BY city""")
def sl6_forecast_by_city(ctx):
    return me.total(ctx.forecast_star, "forecast_revenue", ["city"])


@query("sl7_preview_1000", """
SELECT f.* FROM fact_sales f WHERE date_key IN (SELECT date_key FROM dim_date WHERE year = 1999)
ORDER BY date_key, store_key, product_key LIMIT 1000""")
def sl7_preview_1000(ctx):
    s = ctx.star
    f = joins.filter_by_dim(s.fact_sales, s.dim_date.where(F.col("year") == 1999), "date_key")
    return an.preview(f, ["date_key", "store_key", "product_key"], 1000)


@query("stu_actuals_and_forecasts", """
SELECT date, date_key, store_key, product_key, sales, revenue, margin, 'Actual' AS data_source FROM fact_sales
UNION ALL
SELECT date, date_key, store_key, product_key, predicted_sales, predicted_revenue, predicted_margin, 'Forecast'
FROM fact_forecasts""")
def stu_actuals_and_forecasts(ctx):
    return an.actuals_and_forecasts(ctx.forecast_star)


@query("std_forecast_dates_not_in_calendar", """
SELECT DISTINCT date_key FROM fact_forecasts WHERE date_key NOT IN (SELECT date_key FROM dim_date)""")
def std_forecast_dates_not_in_calendar(ctx):
    """ST-D / JN8: forecast date keys missing from dim_date (Q5)."""
    s = ctx.forecast_star
    return joins.orphan_keys(s.fact_forecasts, s.dim_date, "date_key")


@query("sc12_kpi_text", """
SELECT '$' || format('{:,.2f}', CAST(SUM(revenue) AS DOUBLE) / 1e9) || 'B' AS historical_revenue,
       format('{:,.1f}', SUM(sales) / 1e6) || 'M' AS units_sold,
       '$' || format('{:,.0f}', (SELECT CAST(SUM(predicted_revenue) AS DOUBLE) FROM fact_forecasts) / 1e6) || 'M'
         AS forecast_revenue
FROM fact_sales""")
def sc12_kpi_text(ctx):
    """SC12: KPI display text ($B, M units, $M)."""
    return an.kpi_text(ctx.forecast_star)


@query("sl7_forecast_preview_30day", """
SELECT * FROM fact_forecasts WHERE forecast_horizon = '30-Day'
ORDER BY date_key, store_key, product_key LIMIT 1000""")
def sl7_forecast_preview_30day(ctx):
    """SL7 on the forecast tab: horizon filter, first 1000 rows in key order."""
    f = fc.filter_forecasts(ctx.forecast_star, "30-Day", "All")
    return an.preview(f, ["date_key", "store_key", "product_key"], 1000)
