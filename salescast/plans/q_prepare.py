"""Queries for 2.1–2.3 and 2.8: sources, cleaning, calendar, star builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescast.functions import calendar as cal
from salescast.operators import joins, star as starmod
from salescast.plans.catalog import query
from salescast.sources import io


# --- step 0: the minimum slice (AG4 by year) ---------------------------------
@query("ag4_revenue_by_category_year", """
SELECT category, d.year AS year, CAST(SUM(revenue) AS DOUBLE) AS revenue
FROM fact_sales f
LEFT JOIN dim_product p ON f.product_key = p.product_key
LEFT JOIN dim_date d ON f.date_key = d.date_key
GROUP BY category, d.year""")
def ag4_revenue_by_category_year(ctx):
    """Revenue by product category and year (the flagship query)."""
    s = ctx.star
    j = joins.star_join(joins.star_join(s.fact_sales, s.dim_product, "product_key", cols=["category"]),
                        s.dim_date, "date_key", cols=["year"])
    return j.groupBy("category", "year").agg(F.sum("revenue").cast("double").alias("revenue"))


# --- 2.8 star builders -------------------------------------------------------
@query("sb1_oil_daily", "SELECT date, oil_price FROM oil")
def sb1_oil_daily(ctx):
    """SB1 / WN3 / WN4: daily oil series, gaps inserted and filled."""
    return ctx.cleaned["oil"]


@query("sb1_clean_train", "SELECT date, store_nbr, family, sales, onpromotion FROM train")
def sb1_clean_train(ctx):
    """SB1 / PR1: sales clipped at 0 (NULL kept)."""
    return ctx.cleaned["train"]


@query("ag11_holiday_flags", "SELECT date, is_holiday FROM holidays")
def ag11_holiday_flags(ctx):
    """PR3 + AG11: one flag per date, max over its events."""
    return ctx.cleaned["holidays"]


@query("sb2_features", "SELECT * FROM features")
def sb2_features(ctx):
    """SB2: the flat feature table (JN1–JN4, SC1–SC6, WN1–WN3, PR12)."""
    return ctx.features


@query("sb3_dim_date", "SELECT * FROM dim_date")
def sb3_dim_date(ctx):
    return ctx.star.dim_date


@query("sb4_dim_store", "SELECT * FROM dim_store")
def sb4_dim_store(ctx):
    return ctx.star.dim_store


@query("sb5_dim_product", "SELECT * FROM dim_product")
def sb5_dim_product(ctx):
    return ctx.star.dim_product


@query("sb6_fact_sales", "SELECT * FROM fact_sales")
def sb6_fact_sales(ctx):
    return ctx.star.fact_sales


@query("sb8_integrity", """
SELECT 'fact_sales' AS fact, 'date_key' AS key, 'dim_date' AS dim,
       COUNT(*) AS orphans FROM (SELECT DISTINCT date_key FROM fact_sales) f
       WHERE date_key NOT IN (SELECT date_key FROM dim_date)
UNION ALL
SELECT 'fact_sales', 'store_key', 'dim_store', COUNT(*) FROM (SELECT DISTINCT store_key FROM fact_sales) f
       WHERE store_key NOT IN (SELECT store_key FROM dim_store)
UNION ALL
SELECT 'fact_sales', 'product_key', 'dim_product', COUNT(*) FROM (SELECT DISTINCT product_key FROM fact_sales) f
       WHERE product_key NOT IN (SELECT product_key FROM dim_product)
UNION ALL
SELECT 'fact_forecasts', 'date_key', 'dim_date', COUNT(*) FROM (SELECT DISTINCT date_key FROM fact_forecasts) f
       WHERE date_key NOT IN (SELECT date_key FROM dim_date)
UNION ALL
SELECT 'fact_forecasts', 'store_key', 'dim_store', COUNT(*) FROM (SELECT DISTINCT store_key FROM fact_forecasts) f
       WHERE store_key NOT IN (SELECT store_key FROM dim_store)
UNION ALL
SELECT 'fact_forecasts', 'product_key', 'dim_product', COUNT(*) FROM (SELECT DISTINCT product_key FROM fact_forecasts) f
       WHERE product_key NOT IN (SELECT product_key FROM dim_product)""")
def sb8_integrity(ctx):
    """SB8 / JN8: orphan keys per relation (forecast dates are orphans
    against dim_date by design, Q5)."""
    return starmod.integrity(ctx.forecast_star)


@query("ag21_null_profile", """
SELECT 'dim_date' AS "table", COUNT(*) AS rows, 15 AS columns,
       round(COALESCE(SUM((date IS NULL)::INT + (date_key IS NULL)::INT + (year IS NULL)::INT + (quarter IS NULL)::INT
         + (month IS NULL)::INT + (month_name IS NULL)::INT + (week_of_year IS NULL)::INT + (day_of_week IS NULL)::INT
         + (day_name IS NULL)::INT + (day_of_month IS NULL)::INT + (is_weekend IS NULL)::INT + (fiscal_year IS NULL)::INT
         + (year_month IS NULL)::INT + (year_quarter IS NULL)::INT + (is_holiday IS NULL)::INT) * 100.0 / (COUNT(*) * 15), 0.0), 6) AS null_pct
FROM dim_date
UNION ALL
SELECT 'dim_store', COUNT(*), 7, round(COALESCE(SUM((store_nbr IS NULL)::INT + (city IS NULL)::INT + (state IS NULL)::INT
         + (store_type IS NULL)::INT + (cluster IS NULL)::INT + (store_key IS NULL)::INT + (region IS NULL)::INT) * 100.0 / (COUNT(*) * 7), 0.0), 6)
FROM dim_store
UNION ALL
SELECT 'dim_product', COUNT(*), 3, round(COALESCE(SUM((product_key IS NULL)::INT + (family IS NULL)::INT + (category IS NULL)::INT) * 100.0 / (COUNT(*) * 3), 0.0), 6)
FROM dim_product
UNION ALL
SELECT 'fact_sales', COUNT(*), 11, round(COALESCE(SUM((date IS NULL)::INT + (sales IS NULL)::INT + (onpromotion IS NULL)::INT
         + (oil_price IS NULL)::INT + (is_holiday IS NULL)::INT + (transactions IS NULL)::INT + (date_key IS NULL)::INT
         + (store_key IS NULL)::INT + (product_key IS NULL)::INT + (revenue IS NULL)::INT + (margin IS NULL)::INT) * 100.0 / (COUNT(*) * 11), 0.0), 6)
FROM fact_sales""")
def ag21_null_profile(ctx):
    """AG21 / SB8: rows, columns and null % per star table."""
    s = ctx.star
    return starmod.null_profile({"dim_date": s.dim_date, "dim_store": s.dim_store,
                                 "dim_product": s.dim_product, "fact_sales": s.fact_sales})


@query("ag21_column_nulls", """
SELECT "column", nulls FROM (
  SELECT COUNT(*) - COUNT(date) AS date, COUNT(*) - COUNT(sales) AS sales,
         COUNT(*) - COUNT(onpromotion) AS onpromotion, COUNT(*) - COUNT(oil_price) AS oil_price,
         COUNT(*) - COUNT(is_holiday) AS is_holiday, COUNT(*) - COUNT(transactions) AS transactions,
         COUNT(*) - COUNT(date_key) AS date_key, COUNT(*) - COUNT(store_key) AS store_key,
         COUNT(*) - COUNT(product_key) AS product_key, COUNT(*) - COUNT(revenue) AS revenue,
         COUNT(*) - COUNT(margin) AS margin FROM fact_sales)
UNPIVOT (nulls FOR "column" IN (date, sales, onpromotion, oil_price, is_holiday, transactions,
                                 date_key, store_key, product_key, revenue, margin))""")
def ag21_column_nulls(ctx):
    """AG21: null count per fact column in one pass."""
    return starmod.column_nulls(ctx.star.fact_sales)


# --- 2.1 sources -------------------------------------------------------------
@query("io2_parquet_columns", """
SELECT date_key, store_key, product_key, revenue, sales, margin FROM fact_sales""")
def io2_parquet_columns(ctx):
    """IO2: explicit column subset of the fact (pruned to the scan)."""
    return io.select_columns(ctx.star.fact_sales,
                             ["date_key", "store_key", "product_key", "revenue", "sales", "margin"])


@query("io5_sample", """
SELECT date, store_nbr, family, sales FROM features
ORDER BY md5(concat_ws('|', '42', CAST(date AS VARCHAR), CAST(store_nbr AS VARCHAR), family)), date, store_nbr, family LIMIT 10000""")
def io5_sample(ctx):
    """IO5: deterministic sample of n rows (top-n by an MD5 of seed and keys)."""
    return io.sample_n(ctx.features.select("date", "store_nbr", "family", "sales"), 10000, 42,
                       ["date", "store_nbr", "family"])


# --- 2.2 cleaning / load transforms -----------------------------------------
@query("pr8_load_fact_sales", """
SELECT sales, onpromotion, oil_price, is_holiday, transactions, date_key, store_key, product_key,
       revenue, margin, onpromotion > 0 AS has_promotion FROM fact_sales""")
def pr8_load_fact_sales(ctx):
    """IO9 / PR8: drop raw date, add has_promotion."""
    return io.load_fact(ctx.star.fact_sales, "sales")


@query("pr9_load_fact_forecasts", """
SELECT date_key, store_key, product_key, predicted_sales, predicted_revenue, predicted_margin,
       forecast_horizon, 'Forecast' AS data_source FROM fact_forecasts""")
def pr9_load_fact_forecasts(ctx):
    """IO9 / PR9: drop raw date, tag data_source."""
    return io.load_fact(ctx.forecast_star.fact_forecasts, "forecasts")


@query("pr10_store_label", """
SELECT store_nbr, city, state, store_type, cluster, store_key, region,
       'Store ' || CAST(store_nbr AS VARCHAR) || ' - ' || city AS store_label FROM dim_store""")
def pr10_store_label(ctx):
    """IO9 / PR10: display label per store."""
    return io.load_dim(ctx.star.dim_store, "store")


@query("pr11_dim_date_sort_keys", """
SELECT date_key, year, quarter, month, month_name, week_of_year, day_of_week, day_name, day_of_month,
       is_weekend, fiscal_year, year_month, year_quarter, is_holiday, month AS month_sort,
       day_of_week AS day_sort FROM dim_date""")
def pr11_dim_date_sort_keys(ctx):
    """IO9 / PR11: sort-key columns for month and day names."""
    return io.load_dim(ctx.star.dim_date, "date")


@query("pr4_region_lookup", "SELECT DISTINCT state, region FROM dim_store")
def pr4_region_lookup(ctx):
    """PR4: state -> region with default "Other" (MIDDLE EAST is unmapped)."""
    return ctx.star.dim_store.select("state", "region").distinct()


@query("pr5_date_key_roundtrip", f"""
SELECT date, date_key, CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS date_back
FROM dim_date""")
def pr5_date_key_roundtrip(ctx):
    """PR5: yyyymmdd key and its inverse."""
    return ctx.star.dim_date.select("date", "date_key", cal.from_date_key("date_key").alias("date_back"))


@query("pr18_revenue_in_year", """
SELECT CAST(SUM(revenue) AS DOUBLE) AS revenue, COUNT(*) AS rows FROM fact_sales
WHERE date_key IN (SELECT date_key FROM dim_date WHERE year = 1998)""")
def pr18_revenue_in_year(ctx):
    """PR18 / JN7: year filter applied through the date dimension (semi join)."""
    s = ctx.star
    f = joins.filter_by_dim(s.fact_sales, s.dim_date.where(F.col("year") == 1998), "date_key")
    return f.agg(F.sum("revenue").cast("double").alias("revenue"), F.count(F.lit(1)).alias("rows"))


@query("sc8_week_ending", """
SELECT date, CAST(date_trunc('week', date) AS DATE) + 6 AS week_ending FROM dim_date""")
def sc8_week_ending(ctx):
    """SC8: week bucket labelled by its ending Sunday."""
    return ctx.star.dim_date.select("date", cal.week_ending("date").alias("week_ending"))


@query("sc9_days_between", f"""
SELECT date, date_key, CAST(datediff('day', (SELECT MIN(date) FROM dim_date), date) AS INTEGER) AS days_from_start,
       date + 90 AS plus_90, date - 90 AS minus_90 FROM dim_date""")
def sc9_days_between(ctx):
    """SC9: days between dates, date ± n."""
    d = ctx.star.dim_date
    first = d.agg(F.min("date")).scalar()
    return d.select("date", "date_key", F.datediff(F.col("date"), first).alias("days_from_start"),
                    F.date_add("date", 90).alias("plus_90"), F.date_sub("date", 90).alias("minus_90"))


@query("pr12_fill_zero_check", """
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE transactions = 0) AS zero_transactions,
       COUNT(*) FILTER (WHERE is_holiday = 1) AS holiday_rows,
       COUNT(*) - COUNT(transactions) + COUNT(*) - COUNT(is_holiday) AS nulls_left FROM features""")
def pr12_fill_zero_check(ctx):
    """PR12: after the left joins no transaction or holiday value is NULL."""
    f = ctx.features
    return f.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("transactions") == 0).alias("zero_transactions"),
                 F.count_if(F.col("is_holiday") == 1).alias("holiday_rows"),
                 (F.count(F.lit(1)) - F.count("transactions") + F.count(F.lit(1)) - F.count("is_holiday"))
                 .alias("nulls_left"))
