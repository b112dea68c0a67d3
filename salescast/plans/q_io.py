"""Queries that write and read again (2.1), and small operators that no other
query goes through: column alignment, default keys, registered measures,
filtered top cities, and scoring through a saved model."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salescast.functions import fixed
from salescast.operators import clean, forecast as fc, joins, measures as me
from salescast.operators.ml import encode, train as tr
from salescast.plans.catalog import query
from salescast.plans.prepare import load_star
from salescast.session import shared_folder
from salescast.sources import io
from salescast.sources.versioned import YearTable


def _folder(ctx) -> str:
    return f"{shared_folder(ctx.spark).rstrip('/')}/salescast-io/{uuid.uuid4().hex}"


@query("io1_io3_csv_round_trip", """
SELECT store_nbr, COUNT(*) AS rows, SUM(sales) AS sales, CAST(SUM(onpromotion) AS BIGINT) AS onpromotion, MIN(date) AS first_date
FROM features GROUP BY store_nbr""")
def io1_io3_csv_round_trip(ctx):
    """IO1 + IO3: the sales rows as CSV, read again with the fixed schema."""
    path = _folder(ctx)
    rows = ctx.features.select(F.lit(0).cast("long").alias("id"), "date", "store_nbr", "family", "sales", "onpromotion")
    io.write_csv(rows, path)
    back = io.read_csv(ctx.spark, path, io.RAW_SCHEMAS["train"])
    return back.groupBy("store_nbr").agg(F.count(F.lit(1)).alias("rows"), F.sum("sales").alias("sales"),
                                         F.sum("onpromotion").alias("onpromotion"), F.min("date").alias("first_date"))


@query("io4_star_round_trip", """
SELECT CAST(year(date) AS INTEGER) AS year, COUNT(*) AS rows, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(margin) AS DOUBLE) AS margin
FROM fact_sales GROUP BY 1""")
def io4_star_round_trip(ctx):
    """IO4: the star written with facts by year, and loaded again."""
    path = _folder(ctx)
    io.write_star(ctx.star, path)
    s = load_star(ctx.spark, path)
    return s.fact_sales.groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.sum("revenue").cast("double").alias("revenue"),
                                            F.sum("margin").cast("double").alias("margin"))


@query("io4_star_csv", """
SELECT store_nbr, city, state, store_type, cluster, store_key, region FROM dim_store""")
def io4_star_csv(ctx):
    """IO4, CSV form: every table of the star as CSV; the store dimension read back."""
    path = _folder(ctx)
    io.write_star_csv(ctx.star, path)
    return ctx.spark.read.option("header", True).schema(ctx.star.dim_store.schema).csv(f"{path}/dim_store.csv")


@query("io6_io7_results_round_trip", """
SELECT 'a' AS best_model, CAST(2 AS BIGINT) AS models, (SELECT COUNT(*) FROM features) AS dataset_rows, CAST(2 AS BIGINT) AS leaderboard_rows""")
def io6_io7_results_round_trip(ctx):
    """IO6 + IO7: the results record as JSON and the leaderboard as CSV."""
    path = _folder(ctx)
    lb = ctx.spark.createDataFrame([("b", 0.2, 2.0, 1.0, 9.0, 0.5, 3.0, 2), ("a", 0.1, 1.0, 0.5, 5.0, 0.8, 4.0, 1)],
                                   "model string, normalized_rmse double, rmse double, mae double, mape double, r2 double, "
                                   "training_time double, rank int")
    io.write_csv(lb, f"{path}/leaderboard")
    io.write_results(io.results_frame(lb, "spark", ctx.features.agg(F.count(F.lit(1))).scalar()), f"{path}/results")
    rows = ctx.spark.read.option("header", True).csv(f"{path}/leaderboard").agg(F.count(F.lit(1))).scalar()
    return io.read_results(ctx.spark, f"{path}/results").select(
        "best_model", F.size("all_models").cast("bigint").alias("models"), "dataset_rows", rows.alias("leaderboard_rows"))


@query("io8_saved_model_scores", "SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS different FROM fc_frame")
def io8_saved_model_scores(ctx):
    """IO8: a model and its code tables, saved and loaded, score the next 90
    days exactly as the fitted ones do."""
    path = _folder(ctx)
    enc, (model, _) = ctx.model_frames[2], ctx.fitted("DecisionTree")
    io.save_model(model, f"{path}/model")
    encode.save(enc, f"{path}/encoders")
    frame = fc.scoring_frame(ctx.star, ctx.features, transactions="profile")

    def scored(m, e, out):
        rows = encode.prepare(frame.withColumn("series", F.concat_ws("|", "store_nbr", "family", "date")), e)
        return tr.predict(m, rows).select("series", F.col("prediction").alias(out))

    both = scored(model, enc, "p").join(scored(io.load_model(f"{path}/model"), encode.load(ctx.spark, f"{path}/encoders"), "q"), "series")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("p").eqNullSafe(F.col("q"))).alias("different"))


@query("pr14_align_columns", """
SELECT store_nbr, COUNT(*) AS rows, CAST(0 AS BIGINT) AS missing_sum, SUM(sales) AS sales FROM features GROUP BY store_nbr""")
def pr14_align_columns(ctx):
    """PR14: a column that the frame lacks is added as 0, others stay."""
    f = clean.align_columns(ctx.features.select("store_nbr", "sales"), ["store_nbr", "sales", "not_there"])
    return f.groupBy("store_nbr").agg(F.count(F.lit(1)).alias("rows"), F.sum("not_there").alias("missing_sum"), F.sum("sales").alias("sales"))


@query("fc4_null_on_unscorable", """
SELECT store_nbr, COUNT(*) AS rows, COUNT(*) FILTER (WHERE month = 1) AS unscored FROM features GROUP BY store_nbr""")
def fc4_null_on_unscorable(ctx):
    """FC4: rows that the model gives no number get a NULL prediction."""
    class Rule:
        @staticmethod
        def transform(df):
            return df.withColumn("prediction", F.when(F.col("month") == 1, F.lit(float("nan"))).otherwise(F.col("sales")))

    scored = fc.score(Rule, ctx.features)
    return scored.groupBy("store_nbr").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("predicted_sales").isNull()).alias("unscored"))


@query("me_registered_measure", """
SELECT category, CAST(MAX(revenue) AS DOUBLE) AS largest_sale FROM sales_star GROUP BY category""")
def me_registered_measure(ctx):
    """2.14: a measure registered by the caller, evaluated by category."""
    me.register_measure("largest_sale", lambda df: F.max("revenue").cast("double"))
    return me.custom(ctx.star, "largest_sale", by=["category"])


@query("fc8_top10_cities_filtered", """
SELECT city, CAST(SUM(predicted_revenue) AS DOUBLE) AS forecast_revenue FROM fc_star WHERE forecast_horizon = '30-Day'
GROUP BY city ORDER BY forecast_revenue DESC, city LIMIT 10""")
def fc8_top10_cities_filtered(ctx):
    """FC8 / SL3: the top cities after the explorer's filters."""
    s = ctx.forecast_star
    j = joins.star_join(fc.filter_forecasts(s, "30-Day", "All"), s.dim_store, "store_key", cols=["city"])
    return (j.groupBy("city").agg(F.sum("predicted_revenue").cast("double").alias("forecast_revenue"))
             .orderBy(F.desc("forecast_revenue"), "city").limit(10))


@query("jn11_default_to_key_1", """
SELECT CASE WHEN p.product_key IS NULL OR p.product_key = 2 THEN 1 ELSE p.product_key END AS product_key, COUNT(*) AS rows
FROM fc_pred f LEFT JOIN dim_product p ON f.family = p.family GROUP BY 1""")
def jn11_default_to_key_1(ctx):
    """JN11: families that the product dimension lacks get key 1."""
    preds = fc.demo_forecast(fc.scoring_frame(ctx.star, ctx.features), noise=0.0)
    dim = ctx.star.dim_product.where("product_key <> 2")
    ff = fc.fact_forecasts(preds, dim, ctx.family_to_category, unknown_product_key=fixed.UNKNOWN_PRODUCT_KEY)
    return ff.groupBy("product_key").agg(F.count(F.lit(1)).alias("rows"))


@query("io4_refreshed_star", """
SELECT CAST(year(date) AS INTEGER) AS year, COUNT(*) AS rows, MAX(date) AS last_date, round(SUM(sales), 2) AS sales
FROM features GROUP BY 1""")
def io4_refreshed_star(ctx):
    """IO4: the table loaded without its last day and with wrong values for the
    day before, then refreshed with both days; only their year is rewritten."""
    rows = ctx.features.select("date", "store_nbr", "family", "sales")
    last = rows.agg(F.max("date")).scalar()
    table = YearTable(ctx.spark, _folder(ctx))
    wrong = F.when(F.col("date") == F.date_sub(last, 1), F.lit(-1.0)).otherwise(F.col("sales"))
    table.load(rows.where(F.col("date") < last).withColumn("sales", wrong))
    table.load(rows.where(F.col("date") >= F.date_sub(last, 1)))
    return table.read().groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.max("date").alias("last_date"), F.round(F.sum("sales"), 2).alias("sales"))
