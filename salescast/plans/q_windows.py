"""Queries for 2.6 (windows and time-series shaping)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salescast.operators import keys, timeseries as ts
from salescast.plans.catalog import query
from salescast.session import shared_folder

FF = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query("wn1_oil_lag7_rows", """
SELECT date, store_nbr, family, oil_price,
       LAG(oil_price, 7) OVER (PARTITION BY store_nbr, family ORDER BY date) AS oil_price_lag7
FROM features""")
def wn1_oil_lag7_rows(ctx):
    """WN1: lag of 7 rows (not days) within each series."""
    f = ctx.features.select("date", "store_nbr", "family", "oil_price")
    return ts.lag_rows(f, "oil_price", 7, ["store_nbr", "family"], out="oil_price_lag7")


@query("wn1_oil_lag7_days", """
SELECT f.date, f.store_nbr, f.family, f.oil_price, p.oil_price AS oil_price_lag7d
FROM features f LEFT JOIN features p ON p.store_nbr = f.store_nbr AND p.family = f.family
AND p.date = f.date - 7""")
def wn1_oil_lag7_days(ctx):
    """WN1 in day mode (Q1 option): the value 7 calendar days earlier."""
    f = ctx.features.select("date", "store_nbr", "family", "oil_price")
    return ts.lag_days(f, "oil_price", 7, ["store_nbr", "family"], out="oil_price_lag7d").select(
        "date", "store_nbr", "family", "oil_price", "oil_price_lag7d")


@query("wn2_bfill_lag7", f"""
SELECT date, store_nbr, family, oil_price_lag7,
       CAST(LAG(oil_price, 7) OVER (PARTITION BY store_nbr, family ORDER BY date) IS NULL AS INTEGER) AS was_leading
FROM features""")
def wn2_bfill_lag7(ctx):
    """WN2: the leading NULL lags back-filled from the same series (Q1)."""
    f = ctx.features.select("date", "store_nbr", "family", "oil_price", "oil_price_lag7")
    raw = ts.lag_rows(f, "oil_price", 7, ["store_nbr", "family"], out="__raw")
    return raw.select("date", "store_nbr", "family", "oil_price_lag7",
                      F.col("__raw").isNull().cast("int").alias("was_leading"))


@query("wn4_densify_oil", """
SELECT date, dcoilwtico FROM oil_daily""")
def wn4_densify_oil(ctx):
    """WN4: resampled daily (gap days present with NULL) before filling."""
    from salescast.operators.timeseries import densify_daily
    return densify_daily(ctx.raw.oil, ["dcoilwtico"], "date", ctx.cleaned["train"].select("date"))


@query("wn5_date_spine", """
SELECT CAST(UNNEST(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT MIN(date) AS lo, MAX(date) AS hi FROM train)""")
def wn5_date_spine(ctx):
    """WN5: one row per day between the first and last sales date."""
    b = ctx.cleaned["train"].agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return ts.date_spine(b, F.col("lo"), F.col("hi"))


@query("wn6_rolling30_daily_sales", """
SELECT date, sales, CASE WHEN COUNT(*) OVER w >= 30 THEN round(AVG(sales) OVER w, 6) END AS sales_ma30
FROM (SELECT date, SUM(sales) AS sales FROM train GROUP BY date)
WINDOW w AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def wn6_rolling30_daily_sales(ctx):
    """WN6: 30-row rolling mean of daily total sales (daily frame)."""
    daily = ctx.cleaned["train"].groupBy("date").agg(F.sum("sales").alias("sales"))
    out = ts.rolling_mean(daily, "sales", 30)
    return out.withColumn("sales_ma30", F.round("sales_ma30", 6))


@query("wn7_rank_families", """
SELECT family, SUM(sales) AS sales, CAST(ROW_NUMBER() OVER (ORDER BY SUM(sales) DESC, family) AS INTEGER) AS rank
FROM features GROUP BY family""")
def wn7_rank_families(ctx):
    """WN7: rank by score with a total tie-break."""
    per = ctx.features.groupBy("family").agg(F.sum("sales").alias("sales"))
    return ts.row_rank(per, [("sales", False), "family"]).withColumn("rank", F.col("rank").cast("int"))


@query("wn7_rank_with_ties", """
SELECT date, store_nbr, family, sales, rank() OVER (ORDER BY sales DESC) AS rank, dense_rank() OVER (ORDER BY sales DESC) AS dense_rank
FROM features""")
def wn7_rank_with_ties(ctx):
    """WN7: rank and dense rank of all rows by one measure, over range partitions."""
    rows = ctx.features.select("date", "store_nbr", "family", "sales")
    return keys.global_rank(rows, [("sales", False)], rank="rank", dense_rank="dense_rank")


ORDERS_SQL = """(SELECT o_orderkey, o_orderdate, CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS cents FROM orders)"""


def _orders(ctx):
    cents = F.when(F.col("o_orderpriority") == "1-URGENT", F.round(F.col("o_totalprice") * 100).cast("long"))
    return ctx.table("orders").select("o_orderkey", "o_orderdate", cents.alias("cents"))


@query("wn3_fill_long_series", f"""
SELECT o_orderkey, o_orderdate, coalesce(last_value(cents IGNORE NULLS) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING),
       first_value(cents IGNORE NULLS) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS cents FROM {ORDERS_SQL}""")
def wn3_fill_long_series(ctx):
    """WN3: one series of all orders, filled over range partitions."""
    return ts.fill_series(_orders(ctx), "cents", None, ["o_orderdate", "o_orderkey"])


@query("wn6_rolling30_long_series", f"""
SELECT o_orderkey, CASE WHEN COUNT(*) OVER w >= 30 THEN round(AVG(cents) OVER w, 6) END AS cents_ma30
FROM (SELECT o_orderkey, o_orderdate, coalesce(cents, 0) AS cents FROM {ORDERS_SQL})
WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def wn6_rolling30_long_series(ctx):
    """WN6: 30-row mean along one series of all orders, in blocks."""
    rows = _orders(ctx).fillna(0, ["cents"])
    out = ts.rolling_mean(rows, "cents", 30, None, ["o_orderdate", "o_orderkey"], block=4096)
    return out.select("o_orderkey", F.round("cents_ma30", 6).alias("cents_ma30"))


@query("wn8_key_registry", """
SELECT family, CAST(ROW_NUMBER() OVER (ORDER BY late, family) AS INTEGER) AS product_key
FROM (SELECT family, NOT bool_or(store_nbr < 5) AS late FROM features GROUP BY family)""")
def wn8_key_registry(ctx):
    """WN8 / SB5: keys of the families of some stores, then of all of them; the
    second refresh moves no key."""
    registry = keys.KeyRegistry(ctx.spark, f"{shared_folder(ctx.spark).rstrip('/')}/salescast-keys/{uuid.uuid4().hex}")
    registry.refresh(ctx.features.where("store_nbr < 5"), "family")
    return registry.refresh(ctx.features, "family").select(F.col("value").alias("family"), F.col("key").alias("product_key"))


@query("wn14_target_lags", """
SELECT date, store_nbr, family, sales,
       LAG(sales, 1) OVER w AS sales_lag1, LAG(sales, 7) OVER w AS sales_lag7,
       LAG(sales, 14) OVER w AS sales_lag14, LAG(sales, 28) OVER w AS sales_lag28
FROM features WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date)""")
def wn14_target_lags(ctx):
    f = ctx.features.select("date", "store_nbr", "family", "sales")
    return ts.target_lags(f, "sales", (1, 7, 14, 28))


@query("wn15_target_rolling", """
SELECT date, store_nbr, family, sales,
       round(AVG(sales) OVER w7, 6) AS sales_rmean7, round(stddev_samp(sales) OVER w7, 6) AS sales_rstd7,
       round(AVG(sales) OVER w28, 6) AS sales_rmean28, round(stddev_samp(sales) OVER w28, 6) AS sales_rstd28
FROM features
WINDOW w7 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
       w28 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""")
def wn15_target_rolling(ctx):
    """WN15: rolling mean / std over the previous rows only (no leakage)."""
    f = ctx.features.select("date", "store_nbr", "family", "sales")
    out = ts.target_rolling(f, "sales", (7, 28))
    return out.select("date", "store_nbr", "family", "sales",
                      *[F.round(c, 6).alias(c) for c in
                        ["sales_rmean7", "sales_rstd7", "sales_rmean28", "sales_rstd28"]])
