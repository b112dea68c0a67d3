"""Forecast operators: scoring frame, rule forecast, model
scoring, ``fact_forecasts``, weekly rollup, explorer panels, timeline."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions import calendar as cal
from salescast.functions import fixed
from salescast.operators import clean, joins

SCORING_ORDER = ["date", "store_nbr", "family", "onpromotion", "city", "state", "type", "cluster",
                 "oil_price", "is_holiday", "transactions", "year", "month", "day_of_week",
                 "day_of_month", "week_of_year", "quarter", "is_weekend", "is_payday",
                 "is_month_start", "oil_price_lag7", "store_key"]


def last_value(features: DataFrame, col: str, order_cols=("date",)) -> "F.Column":
    """Value of ``col`` on the last row by ``order_cols`` — a scalar subquery
    (one-row aggregate), so it joins nothing."""
    key = F.struct(*order_cols) if len(order_cols) > 1 else F.col(order_cols[0])
    return features.agg(F.max_by(col, key)).scalar()


def scoring_frame(star, features: DataFrame, horizon: int = fixed.FORECAST_HORIZON_DAYS,
                  transactions: str = "constant") -> DataFrame:
    """FC1 / FC2: the frame to score — every series × the next ``horizon``
    days after the last actual date, with store attributes, calendar columns
    and assumed values.

    ``transactions="constant"``: transactions 2000, oil and oil lag = last oil
    price (FC1).  ``"profile"``: transactions = mean per (store, weekday) from
    history (default 2000), oil lag = last row's lag (FC2).
    """
    start = F.date_add(features.agg(F.max("date")).scalar(), 1)
    series = features.select("store_nbr", "family").distinct()
    grid = joins.scoring_grid(series, start, horizon)
    stores = star.dim_store.select(F.col("store_key"), "city", "state",
                                   F.col("store_type").alias("type"), "cluster")
    frame = grid.join(stores, grid.store_nbr == stores.store_key, "left")
    frame = frame.withColumns(cal.calendar_features("date"))
    last_oil = last_value(features, "oil_price")
    frame = frame.withColumns({
        "onpromotion": F.lit(0),
        "is_holiday": F.lit(0),
        "oil_price": last_oil,
    })
    if transactions == "profile":
        prof = (features.groupBy("store_nbr", "day_of_week")
                        .agg(F.avg("transactions").alias("__avg_tx")))
        frame = (frame.join(prof, ["store_nbr", "day_of_week"], "left")
                      .withColumn("transactions",
                                  F.coalesce(F.col("__avg_tx"), F.lit(float(fixed.DEFAULT_TRANSACTIONS))))
                      .drop("__avg_tx"))
        frame = frame.withColumn("oil_price_lag7",
                                 last_value(features, "oil_price_lag7", ("store_nbr", "family", "date")))
    else:
        frame = frame.withColumns({"transactions": F.lit(float(fixed.DEFAULT_TRANSACTIONS)),
                                   "oil_price_lag7": last_oil})
    return frame.select(*SCORING_ORDER)


def demo_forecast(frame: DataFrame, noise: float = fixed.DEMO_NOISE_SD, seed: int = 42,
                  family_base: Mapping | None = None, out: str = "predicted_sales") -> DataFrame:
    """FC5: rule-based forecast

        base(family, default 50) × 1.15 on weekends
        × (1 + 0.15·sin(2π(month − 3)/12)) × (0.8 + 0.4·(store mod 10)/10)
        × N(1, noise), clipped at 0 and rounded half to even.

    The normal draws come from an MD5 of (seed, date, store, family), so they
    are the same whatever the partitioning; ``noise=0`` draws nothing.
    """
    base = clean.lookup("family", family_base or fixed.DEMO_FAMILY_BASE, fixed.DEMO_DEFAULT_BASE, "double")
    dow = F.when(F.col("is_weekend") == 1, F.lit(fixed.DEMO_WEEKEND_EFFECT)).otherwise(F.lit(1.0))
    month_effect = F.lit(1.0) + F.lit(fixed.DEMO_MONTH_AMPLITUDE) * F.sin(
        F.lit(2 * math.pi) * (F.col("month") - 3) / 12)
    store_effect = F.lit(0.8) + F.lit(0.4) * (F.col("store_nbr") % 10) / 10
    pred = base * dow * month_effect * store_effect
    if noise > 0:
        pred = pred * (F.lit(1.0) + F.lit(noise) * _normal(seed))
    return frame.withColumn(out, cal.post_process(pred))


def _normal(seed: int) -> "F.Column":
    """A standard normal draw for each (date, store, family): Box-Muller over
    two uniform draws of 48 hash bits."""
    def uniform(tag):
        h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(tag), F.col("date").cast("string"),
                              F.col("store_nbr").cast("string"), "family"))
        return (F.conv(F.substring(h, 1, 12), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 48))
    return F.sqrt(-2 * F.log(uniform("u"))) * F.cos(2 * F.lit(math.pi) * uniform("v"))


def score(model, frame: DataFrame, features_col: str = "features", out: str = "predicted_sales",
          on_error: str = "null") -> DataFrame:
    """FC3 / FC4: apply a fitted ``PipelineModel`` (Spark partitions replace
    request batches), clip and round.  Rows whose features cannot be scored
    (NULL input) get a NULL prediction instead of failing the job."""
    scored = model.transform(frame)
    pred = F.col("prediction")
    if on_error == "null":
        pred = F.when(F.isnan(pred), F.lit(None)).otherwise(pred)
    return scored.withColumn(out, cal.post_process(pred)).drop("prediction", features_col)


FACT_FORECASTS_ORDER = ["date", "date_key", "store_key", "product_key", "predicted_sales",
                        "predicted_revenue", "predicted_margin", "forecast_horizon"]


def fact_forecasts(preds: DataFrame, dim_product: DataFrame,
                   family_to_category: Mapping | None = None,
                   prices: Mapping | None = None, rates: Mapping | None = None,
                   sales_col: str = "predicted_sales", unknown_product_key: int | None = None) -> DataFrame:
    """FC6: forecast fact — keys, predicted units, revenue and margin rounded
    half-even to cents (margin from the rounded revenue), horizon bucket.

    A family missing from ``dim_product`` keeps a NULL key, or gets
    ``unknown_product_key`` when given (JN11's default-to-key-1 variant)."""
    df = preds.join(dim_product.select("family", "product_key"), "family", "left")
    if unknown_product_key is not None:
        df = df.withColumn("product_key", F.coalesce(F.col("product_key"), F.lit(unknown_product_key)))
    cat = clean.category_col("family", family_to_category)
    revenue = F.bround(F.col(sales_col).cast("decimal(18,4)") * clean.price_col(cat, prices), 2)
    df = df.withColumn("predicted_revenue", revenue.cast("decimal(18,4)"))
    margin = F.bround(F.col("predicted_revenue") * clean.margin_rate_col(cat, rates), 2)
    df = df.withColumn("predicted_margin", margin.cast("decimal(18,4)"))
    first_day = preds.agg(F.min("date")).scalar()
    return (df.withColumn("date_key", cal.date_key("date"))
              .withColumn("store_key", F.col("store_nbr"))
              .withColumn("predicted_sales", F.col(sales_col).cast("double"))
              .withColumn("forecast_horizon", cal.horizon_label(F.datediff(F.col("date"), first_day)))
              .select(*FACT_FORECASTS_ORDER))


def weekly_rollup(ff: DataFrame, cols=("predicted_sales", "predicted_revenue", "predicted_margin")) -> DataFrame:
    """AG12 / FC7: weekly sums labelled by the ending Sunday; weeks inside
    the range with no rows are present with 0."""
    wk = ff.groupBy(cal.week_ending("date").alias("date")).agg(*[F.sum(c).alias(c) for c in cols])
    bounds = wk.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("date"))
    out = spine.join(wk, "date", "left")
    return out.select("date", *[F.coalesce(F.col(c), F.lit(0).cast(wk.schema[c].dataType)).alias(c)
                                for c in cols])


def export_forecasts(ff: DataFrame, path: str) -> None:
    """FC7: the forecast fact as Parquet and CSV, plus the weekly rollup CSV."""
    from salescast.sources import io
    root = path.rstrip("/")
    io.write_parquet(ff, f"{root}/fact_forecasts.parquet")
    io.write_csv(ff, f"{root}/fact_forecasts.csv")
    io.write_csv(weekly_rollup(ff), f"{root}/fact_forecasts_weekly.csv")


def horizon_breakdown(ff: DataFrame) -> DataFrame:
    """FC9 / AG15: rows per forecast horizon."""
    return ff.groupBy("forecast_horizon").agg(F.count(F.lit(1)).alias("rows"))


def filter_forecasts(star, horizon: str = "All", city: str = "All") -> DataFrame:
    """FC8 filters: horizon equality and city membership (semi join)."""
    fc = clean.where_eq(star.fact_forecasts, "forecast_horizon", horizon)
    if city not in (None, "All"):
        stores = star.dim_store.where(F.col("city") == city)
        fc = joins.filter_by_dim(fc, stores, "store_key")
    return fc


def explore_kpis(fc: DataFrame) -> DataFrame:
    return fc.agg(F.sum("predicted_revenue").alias("forecast_revenue"),
                  F.sum("predicted_sales").alias("forecast_units"),
                  F.sum("predicted_margin").alias("forecast_margin"))


def explore_daily(fc: DataFrame) -> DataFrame:
    """AG3: daily revenue and units."""
    return (fc.groupBy("date_key").agg(F.sum("predicted_revenue").alias("revenue"),
                                       F.sum("predicted_sales").alias("units"))
              .withColumn("date", cal.from_date_key("date_key")))


def timeline(star) -> DataFrame:
    """FC10: daily actual and forecast revenue on one axis (ST-U) with the
    forecast start date on every row."""
    actual = (star.fact_sales.groupBy("date_key").agg(F.sum("revenue").alias("revenue"))
              .withColumn("data_source", F.lit("Actual")))
    fcst = (star.fact_forecasts.groupBy("date_key")
            .agg(F.sum("predicted_revenue").alias("revenue"))
            .withColumn("data_source", F.lit("Forecast")))
    start = star.fact_forecasts.agg(F.min("date_key")).scalar()
    return (actual.unionByName(fcst)
                  .withColumn("date", cal.from_date_key("date_key"))
                  .withColumn("forecast_start", cal.from_date_key(start)))
