"""Queries for 2.10 (forecast operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescast.operators import analytics as an
from salescast.operators import forecast as fc
from salescast.plans.catalog import query
from salescast.plans.oracle_base import raw_forecast_sql

LAST_OIL = "(SELECT arg_max(oil_price, date) FROM features)"
FRAME_COLS = """date, store_nbr, family, onpromotion, city, state, type, cluster, oil_price, is_holiday,
       transactions, year, month, day_of_week, day_of_month, week_of_year, quarter, is_weekend, is_payday,
       is_month_start, oil_price_lag7, store_key"""


@query("fc1_scoring_frame", f"""
SELECT {FRAME_COLS} FROM (
  SELECT *, 0 AS onpromotion, 0 AS is_holiday, {LAST_OIL} AS oil_price, CAST(2000 AS DOUBLE) AS transactions,
         {LAST_OIL} AS oil_price_lag7 FROM fc_frame)""")
def fc1_scoring_frame(ctx):
    """FC1: grid + store attributes + calendar + assumed values."""
    return fc.scoring_frame(ctx.star, ctx.features)


@query("fc2_scoring_frame_profile", f"""
WITH prof AS (SELECT store_nbr, day_of_week, AVG(transactions) AS t FROM features GROUP BY ALL),
lastlag AS (SELECT oil_price_lag7 FROM features ORDER BY store_nbr DESC, family DESC, date DESC LIMIT 1)
SELECT {FRAME_COLS} FROM (
  SELECT f.*, 0 AS onpromotion, 0 AS is_holiday, {LAST_OIL} AS oil_price,
         COALESCE(p.t, CAST(2000 AS DOUBLE)) AS transactions, (SELECT oil_price_lag7 FROM lastlag) AS oil_price_lag7
  FROM fc_frame f LEFT JOIN prof p ON f.store_nbr = p.store_nbr AND f.day_of_week = p.day_of_week)""")
def fc2_scoring_frame_profile(ctx):
    """FC2: transactions from the (store, weekday) profile, default 2000."""
    return fc.scoring_frame(ctx.star, ctx.features, transactions="profile")


@query("fc5_rule_forecast", """
SELECT date, store_nbr, family, predicted_sales FROM fc_pred""")
def fc5_rule_forecast(ctx):
    """FC5: the rule-based forecast at noise 0 (exact)."""
    f = fc.demo_forecast(fc.scoring_frame(ctx.star, ctx.features), noise=0.0)
    return f.select("date", "store_nbr", "family", "predicted_sales")


def uniform_sql(tag):
    """The oracle's uniform draw: 48 bits of an MD5 of seed, tag and keys."""
    h = f"md5(concat_ws('|', '42', '{tag}', CAST(date AS VARCHAR), CAST(store_nbr AS VARCHAR), family))"
    return f"((CAST('0x' || substr({h}, 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE)"


@query("fc5_rule_forecast_noisy", f"""
SELECT date, store_nbr, family, round_even(greatest(raw * (1.0::DOUBLE + 0.15::DOUBLE * sqrt(-2 * ln({uniform_sql('u')}))
       * cos(2 * pi() * {uniform_sql('v')})), 0), 0) AS predicted_sales
FROM (SELECT date, store_nbr, family, {raw_forecast_sql()} AS raw FROM fc_frame)""")
def fc5_rule_forecast_noisy(ctx):
    """FC5 with N(1, 0.15) noise drawn from a hash of seed, date, store and family."""
    f = fc.demo_forecast(fc.scoring_frame(ctx.star, ctx.features), noise=0.15, seed=42)
    return f.select("date", "store_nbr", "family", "predicted_sales")


@query("fc6_fact_forecasts", "SELECT * FROM fact_forecasts")
def fc6_fact_forecasts(ctx):
    """FC6: the forecast fact (keys, units, revenue and margin in cents, horizon)."""
    return ctx.forecast_star.fact_forecasts


@query("fc7_weekly_rollup", """
WITH wk AS (SELECT CAST(date_trunc('week', date) AS DATE) + 6 AS date, SUM(predicted_sales) AS s,
                   SUM(predicted_revenue) AS r, SUM(predicted_margin) AS m FROM fact_forecasts GROUP BY 1),
spine AS (SELECT CAST(UNNEST(generate_series(CAST(MIN(date) AS TIMESTAMP), CAST(MAX(date) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS date FROM wk)
SELECT s.date, COALESCE(s2, 0) AS predicted_sales, CAST(COALESCE(r, 0) AS DOUBLE) AS predicted_revenue,
       CAST(COALESCE(m, 0) AS DOUBLE) AS predicted_margin
FROM spine s LEFT JOIN (SELECT date, s AS s2, r, m FROM wk) w ON s.date = w.date""")
def fc7_weekly_rollup(ctx):
    """FC7 / AG12: weekly sums labelled by the ending Sunday."""
    w = fc.weekly_rollup(ctx.forecast_star.fact_forecasts)
    return w.select("date", "predicted_sales", F.col("predicted_revenue").cast("double"),
                    F.col("predicted_margin").cast("double"))


@query("fc8_explorer_kpis", """
SELECT CAST(SUM(predicted_revenue) AS DOUBLE) AS forecast_revenue, SUM(predicted_sales) AS forecast_units,
       CAST(SUM(predicted_margin) AS DOUBLE) AS forecast_margin
FROM fact_forecasts WHERE forecast_horizon = '30-Day'
AND store_key IN (SELECT store_key FROM dim_store WHERE city = 'NATION_7')""")
def fc8_explorer_kpis(ctx):
    """FC8: horizon + city filtered forecast KPIs."""
    k = fc.explore_kpis(fc.filter_forecasts(ctx.forecast_star, "30-Day", "NATION_7"))
    return k.select(F.col("forecast_revenue").cast("double"), "forecast_units",
                    F.col("forecast_margin").cast("double"))


@query("fc8_explorer_daily", """
SELECT date_key, CAST(SUM(predicted_revenue) AS DOUBLE) AS revenue, SUM(predicted_sales) AS units,
       CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS date
FROM fact_forecasts WHERE forecast_horizon = '60-Day' GROUP BY date_key""")
def fc8_explorer_daily(ctx):
    """FC8 / AG3: daily revenue and units for one horizon, all cities."""
    d = fc.explore_daily(fc.filter_forecasts(ctx.forecast_star, "60-Day", "All"))
    return d.withColumn("revenue", F.col("revenue").cast("double")).select("date_key", "revenue", "units", "date")


@query("fc8_explorer_by_category", """
SELECT category, CAST(SUM(predicted_revenue) AS DOUBLE) AS predicted_revenue FROM fc_star
WHERE city = 'NATION_3' GROUP BY category""")
def fc8_explorer_by_category(ctx):
    """FC8 / AG6: forecast revenue by category for one city."""
    s = ctx.forecast_star
    f = fc.filter_forecasts(s, "All", "NATION_3")
    return an.by_dim(s.replace(fact_forecasts=f), "category", "forecast")


@query("ag12_weekly_actual_revenue", """
WITH wk AS (SELECT CAST(date_trunc('week', date) AS DATE) + 6 AS date, SUM(revenue) AS r, SUM(sales) AS s
            FROM fact_sales GROUP BY 1),
spine AS (SELECT CAST(UNNEST(generate_series(CAST(MIN(date) AS TIMESTAMP), CAST(MAX(date) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS date FROM wk)
SELECT s.date, CAST(COALESCE(r, 0) AS DOUBLE) AS revenue, COALESCE(w.s, 0) AS sales
FROM spine s LEFT JOIN wk w ON s.date = w.date""")
def ag12_weekly_actual_revenue(ctx):
    """AG12 on actuals: weekly sums, empty weeks as 0."""
    w = fc.weekly_rollup(ctx.star.fact_sales, ("revenue", "sales"))
    return w.select("date", F.col("revenue").cast("double"), "sales")
