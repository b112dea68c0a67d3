"""ML8–ML14, ML17: metrics, leaderboard, residuals, histogram, accuracy by
grain, deviation flags.  Everything is one or two aggregation passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.functions import calendar as cal


def metric_columns(y: str = "actual", p: str = "predicted") -> list[Column]:
    """RMSE, MAE, R², NRMSE (÷ range of actuals, NULL for a constant range),
    MAPE over actual > 0 (× 100), WAPE (× 100), n — rounded to 6 places."""
    e = F.col(y) - F.col(p)
    sse = F.sum(e * e)
    n = F.count(F.lit(1))
    rmse = F.sqrt(sse / n)
    sst = F.var_pop(F.col(y)) * n
    rng = F.max(F.col(y)) - F.min(F.col(y))
    ape = F.when(F.col(y) > 0, F.abs(e) / F.abs(F.col(y)))
    return [
        F.round(rmse, 6).alias("rmse"),
        F.round(F.avg(F.abs(e)), 6).alias("mae"),
        F.round(1 - F.try_divide(sse, sst), 6).alias("r2"),
        F.round(F.try_divide(rmse, F.when(rng > 0, rng)), 6).alias("normalized_rmse"),
        F.round(F.avg(ape) * 100, 6).alias("mape"),
        F.round(F.try_divide(F.sum(F.abs(e)), F.sum(F.abs(F.col(y)))) * 100, 6).alias("wape"),
        n.alias("n"),
    ]


def metrics(df: DataFrame, y: str = "actual", p: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """ML8 (PR13: pairs with a missing side are dropped first)."""
    clean = df.dropna(subset=[y, p])
    return clean.groupBy(*by).agg(*metric_columns(y, p))


def leaderboard(metrics_df: DataFrame) -> DataFrame:
    """ML9 / WN7: ascending by NRMSE, rank and best marker."""
    w = Window.orderBy(F.col("normalized_rmse").asc_nulls_last(), F.col("model"))
    return (metrics_df.withColumn("rank", F.row_number().over(w))
                      .withColumn("is_best", F.col("rank") == 1))


def best_model(lb: DataFrame) -> DataFrame:
    """ML10: the top row of the leaderboard."""
    return lb.where(F.col("rank") == 1)


def residuals(df: DataFrame, y: str = "actual", p: str = "predicted") -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(p))


def residual_summary(df: DataFrame, y: str = "actual", p: str = "predicted") -> DataFrame:
    """ML12: mean and sample std of the residuals."""
    r = residuals(df.dropna(subset=[y, p]), y, p)
    return r.agg(F.round(F.avg("residual"), 6).alias("mean_residual"),
                 F.round(F.stddev_samp("residual"), 6).alias("std_residual"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """ML13: ``bins`` equal-width bins from min to max, last bin closed; bins
    with no rows are present with count 0."""
    b = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    lo, hi = b.select("lo").scalar(), b.select("hi").scalar()
    width = (hi - lo) / bins
    idx = F.least(F.floor((F.col(col) - lo) / (hi - lo) * bins) + 1, F.lit(bins)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (spine.join(counts, "bin", "left")
                 .select("bin", F.round(lo + (F.col("bin") - 1) * width, 6).alias("lower"),
                         F.round(lo + F.col("bin") * width, 6).alias("upper"),
                         F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def metrics_by_grain(df: DataFrame, grain: str, y: str = "actual", p: str = "predicted",
                     category_col: str = "category") -> DataFrame:
    """ML14: accuracy of totals at a coarser grain — ``daily`` and
    ``weekly`` sum both sides per period first; ``category`` keeps rows and
    scores each category."""
    clean = df.dropna(subset=[y, p])
    if grain == "category":
        return clean.groupBy(category_col).agg(*metric_columns(y, p))
    key = F.col("date") if grain == "daily" else cal.week_ending("date")
    per = clean.groupBy(key.alias("period")).agg(F.sum(y).alias(y), F.sum(p).alias(p))
    return per.agg(*metric_columns(y, p)).select(F.lit(grain).alias("grain"), "*")


def deviation_flags(df: DataFrame, keys: Sequence[str], k: float = 2.0,
                    y: str = "actual", p: str = "predicted") -> DataFrame:
    """ML17: rows whose residual is more than ``k`` per-series standard
    deviations away from zero (series std from an aggregate, joined back)."""
    r = residuals(df.dropna(subset=[y, p]), y, p)
    sd = r.groupBy(*keys).agg(F.stddev_samp("residual").alias("__sd"))
    return (r.join(sd, list(keys))
             .withColumn("is_deviation", F.abs(F.col("residual")) > k * F.col("__sd"))
             .drop("__sd"))
