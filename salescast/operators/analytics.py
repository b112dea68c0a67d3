"""Aggregations, top-k and set operations.

All group-bys are hash aggregates with map-side partial aggregation, so a key
holding a large share of the rows is reduced inside each map task before the
shuffle.  One-row results (grand totals) are used as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.functions import calendar as cal
from salescast.operators import joins
from salescast.session import materialize


def _d(c: Column) -> Column:
    """Money sums leave the engine as double (exact decimal sum, one final cast)."""
    return c.cast("double")


# AG1 -------------------------------------------------------------------------
def kpis(star) -> DataFrame:
    """Historical revenue / units and forecast revenue / units / margin.

    Both facts are projected onto one set of columns and aggregated together:
    one scan of each fact, one aggregation, no join or subquery."""
    fc = star.fact_forecasts
    none_d, none_m = F.lit(None).cast("double"), F.lit(None).cast("decimal(18,4)")
    parts = star.fact_sales.select(F.col("revenue").alias("r"), F.col("sales").alias("u"),
                                   none_m.alias("fr"), none_d.alias("fu"), none_m.alias("fm"))
    if fc is not None:
        parts = parts.unionByName(fc.select(none_m.alias("r"), none_d.alias("u"),
                                            F.col("predicted_revenue").alias("fr"),
                                            F.col("predicted_sales").alias("fu"),
                                            F.col("predicted_margin").alias("fm")))
    out = parts.agg(_d(F.sum("r")).alias("total_revenue"), F.sum("u").alias("total_units"),
                    _d(F.sum("fr")).alias("forecast_revenue"), F.sum("fu").alias("forecast_units"),
                    _d(F.sum("fm")).alias("forecast_margin"))
    return out if fc is not None else out.select("total_revenue", "total_units")


def kpi_text(star) -> DataFrame:
    """SC12: the dashboard's KPI cards as display text."""
    k = kpis(star)
    return k.select(cal.money_text("total_revenue", "B", 2).alias("historical_revenue"),
                    F.concat(F.format_number(F.col("total_units") / 1e6, 1), F.lit("M")).alias("units_sold"),
                    cal.money_text("forecast_revenue", "M", 0).alias("forecast_revenue"))


# AG2 -------------------------------------------------------------------------
def daily_totals(fact: DataFrame, col: str, out: str | None = None, key: str = "date_key") -> DataFrame:
    """Daily sum of ``col`` with the date restored from the key."""
    agg = fact.groupBy(key).agg(F.sum(col).alias(out or col))
    return agg.withColumn("date", cal.from_date_key(key)) if key == "date_key" else agg


# AG4–AG6 ---------------------------------------------------------------------
def by_dim(star, dim_col: str, fact: str = "sales") -> DataFrame:
    """Revenue (actual or forecast) by one dimension attribute, ascending."""
    dims = {"category": ("dim_product", "product_key"), "family": ("dim_product", "product_key"),
            "store_type": ("dim_store", "store_key"), "city": ("dim_store", "store_key"),
            "state": ("dim_store", "store_key"), "region": ("dim_store", "store_key"),
            "year": ("dim_date", "date_key"), "month": ("dim_date", "date_key")}
    dim_name, key = dims[dim_col]
    t = star.tables()
    f = star.fact_sales if fact == "sales" else star.fact_forecasts
    col = "revenue" if fact == "sales" else "predicted_revenue"
    j = joins.star_join(f, t[dim_name], key, cols=[dim_col])
    return j.groupBy(dim_col).agg(_d(F.sum(col)).alias(col)).orderBy(col)


# AG7 -------------------------------------------------------------------------
def profile_by(df: DataFrame, key: str, col: str) -> DataFrame:
    """sum, mean and sample std per key, descending by sum."""
    return (df.groupBy(key).agg(F.sum(col).alias("total"),
                                F.round(F.avg(col), 6).alias("mean"),
                                F.round(F.stddev_samp(col), 6).alias("std"))
              .orderBy(F.desc("total"), key))


# AG8 / AG9 / AG10 ------------------------------------------------------------
def mean_by(df: DataFrame, keys: Sequence[str] | str, col: str, out: str = "mean") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.round(F.avg(col), 6).alias(out))


def seasonal_profile(df: DataFrame, part: str, col: str = "sales") -> DataFrame:
    """Mean by weekday (Mon = 0) or by month."""
    expr = cal.day_of_week("date") if part == "day_of_week" else cal.month("date")
    return df.groupBy(expr.alias(part)).agg(F.round(F.avg(col), 6).alias("mean_" + col))


def avg_transactions(df: DataFrame) -> DataFrame:
    return (df.groupBy("store_nbr", "day_of_week")
              .agg(F.round(F.avg("transactions"), 6).alias("avg_transactions")))


# AG13 ------------------------------------------------------------------------
def avg_daily(fact: DataFrame, col: str, key: str = "date_key") -> DataFrame:
    """Average of the daily sums (two-level aggregation)."""
    daily = fact.groupBy(key).agg(F.sum(col).alias("__d"))
    # exact total of the daily sums, then one IEEE division by the day count
    return daily.agg(F.round(_d(F.sum("__d")) / F.count(F.lit(1)), 6).alias("avg_daily_" + col))


# AG14 / AG15 / AG16 ----------------------------------------------------------
def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.countDistinct(c).alias("n_" + c) for c in cols])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)


def slicer_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


# AG17 ------------------------------------------------------------------------
def corr(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation over pairs where both are present."""
    return df.agg(F.round(F.corr(a, b), 6).alias(f"corr_{a}_{b}"))


def daily_sales_vs_oil(train: DataFrame, oil_raw: DataFrame) -> DataFrame:
    daily = train.groupBy("date").agg(F.sum("sales").alias("sales"))
    return daily.join(oil_raw.select("date", F.col("dcoilwtico").alias("oil_price")), "date", "left")


# AG18 ------------------------------------------------------------------------
def holiday_effect(train: DataFrame, holidays_raw: DataFrame) -> DataFrame:
    """Mean daily sales on holidays vs other days, and the % difference."""
    daily = train.groupBy("date").agg(F.sum("sales").alias("sales"))
    hol = holidays_raw.where(~F.col("transferred")).select("date").distinct()
    flagged = joins.flag_in_dim(daily, hol, "date", "is_holiday")
    m = flagged.agg(F.avg(F.when(F.col("is_holiday") == 1, F.col("sales"))).alias("h"),
                    F.avg(F.when(F.col("is_holiday") == 0, F.col("sales"))).alias("r"))
    return m.select(F.round("h", 6).alias("holiday_mean"), F.round("r", 6).alias("regular_mean"),
                    F.round((F.try_divide(F.col("h"), F.col("r")) - 1) * 100, 6).alias("pct_diff"))


# AG19 ------------------------------------------------------------------------
def top_share(df: DataFrame, key: str, col: str, n: int) -> DataFrame:
    """Share of the total held by the top ``n`` keys."""
    per = df.groupBy(key).agg(F.sum(col).alias("__v"))
    total = per.agg(F.sum("__v")).scalar()
    top = per.orderBy(F.desc("__v"), key).limit(n)
    return top.agg(F.round(F.try_divide(F.sum("__v"), total), 6).alias(f"top{n}_share"))


# AG20 / AG22 / AG23 ----------------------------------------------------------
def exact_quantiles(df: DataFrame, cols: Sequence[str], ps: Sequence[float]) -> DataFrame:
    """(column, q): for each column the quantiles ``ps``, linearly interpolated.

    Distinct values are counted, ordered over range partitions and numbered
    from the partitions' totals, so no task holds more than one range of
    values; the two neighbours of each quantile are then picked by rank."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])))
    counts = long.where("v is not null").groupBy("column", "v").agg(F.count("*").alias("n"))
    ranged = materialize(counts.repartitionByRange("column", "v").withColumn("__pid", F.spark_partition_id()), name="quantiles")
    parts = ranged.groupBy("column", "__pid").agg(F.sum("n").alias("m"))
    w = Window.partitionBy("column")
    parts = parts.select("column", "__pid", F.sum("m").over(w).alias("total"),
                         (F.sum("m").over(w.orderBy("__pid")) - F.col("m")).alias("lead"))
    inside = Window.partitionBy("column", "__pid").orderBy("v")
    placed = (ranged.withColumn("upto", F.sum("n").over(inside)).join(parts, ["column", "__pid"])
              .select("column", "v", "total", (F.col("lead") + F.col("upto") - F.col("n")).alias("start"), (F.col("lead") + F.col("upto")).alias("end")))
    at = [F.struct(F.lit(i).alias("i"), (F.lit(p) * (F.col("total") - 1)).alias("h")) for i, p in enumerate(ps)]
    near = F.filter(F.array(*at), lambda t: ((F.floor(t["h"]) >= F.col("start")) & (F.floor(t["h"]) < F.col("end")))
                    | ((F.ceil(t["h"]) >= F.col("start")) & (F.ceil(t["h"]) < F.col("end"))))
    picked = placed.select("column", "v", F.explode(near).alias("t")).groupBy("column", "t.i").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.max(F.col("t.h") - F.floor("t.h")).alias("f"))
    q = F.transform(F.array_sort(F.collect_list(F.struct("i", (F.col("lo") * (1 - F.col("f")) + F.col("hi") * F.col("f")).alias("q")))), lambda s: s["q"])
    return picked.groupBy("column").agg(q.alias("q"))


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """count, mean, std, min, 25/50/75 % (linear interpolation), max per column,
    one output row per column.  Exact quantiles are picked by rank from
    range-partitioned value counts; ``exact=False`` takes a mergeable sketch
    (relative rank error 1 / ``accuracy``) in the one aggregation pass.
    """
    stats = []
    for c in cols:
        x = F.col(c).cast("double")
        stats.append(F.struct(
            F.lit(c).alias("column"), F.count(x).alias("count"),
            F.round(F.avg(x), 6).alias("mean"), F.round(F.stddev_samp(x), 6).alias("std"),
            F.min(x).alias("min"),
            *[(F.lit(None).cast("double") if exact else F.percentile_approx(x, p, accuracy).cast("double")).alias(f"p{p * 100:.0f}")
              for p in (0.25, 0.5, 0.75)],
            F.max(x).alias("max")).alias(f"__s{len(stats)}"))
    row = df.agg(*stats)
    out = row.select(F.inline(F.array(*[F.col(f"__s{i}") for i in range(len(cols))])))
    if exact:
        q = exact_quantiles(df, cols, (0.25, 0.5, 0.75)).withColumnRenamed("column", "__column")
        out = out.join(q, F.col("column") == F.col("__column"), "left").select(
            *[F.round(F.get("q", F.lit(["p25", "p50", "p75"].index(c))), 6).alias(c) if c in ("p25", "p50", "p75") else c for c in out.columns])
    return out


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[e for c in cols for e in (F.min(c).alias("min_" + c), F.max(c).alias("max_" + c))])


def prediction_summary(df: DataFrame, col: str, exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    med = (exact_quantiles(df, [col], (0.5,)).select(F.get("q", F.lit(0))).scalar() if exact
           else F.percentile_approx(col, 0.5, accuracy).cast("double"))
    return df.agg(F.round(F.avg(col), 6).alias("mean"), F.max(med).alias("median") if exact else med.alias("median"),
                  F.min(col).alias("min"), F.max(col).alias("max"))


# SL2–SL8 ---------------------------------------------------------------------
def top_k(df: DataFrame, key: Sequence[str] | str, col: str, k: int, agg: str = "sum",
          out: str | None = None) -> DataFrame:
    """Top ``k`` keys by an aggregate, ties broken by key (TakeOrderedAndProject)."""
    keys = [key] if isinstance(key, str) else list(key)
    fn = {"sum": F.sum, "avg": F.avg}[agg]
    val = fn(col)
    if agg == "avg":
        val = F.round(val, 6)
    out = out or f"{agg}_{col}"
    return df.groupBy(*keys).agg(val.alias(out)).orderBy(F.desc(out), *keys).limit(k)


def preview(df: DataFrame, keys: Sequence[str], n: int = 1000) -> DataFrame:
    """SL7: first ``n`` rows in key order."""
    return df.orderBy(*keys).limit(n)


# ST-U ------------------------------------------------------------------------
def actuals_and_forecasts(star) -> DataFrame:
    """Both facts on shared keys, tagged with ``data_source``."""
    a = star.fact_sales.select("date", "date_key", "store_key", "product_key",
                               F.col("sales"), F.col("revenue"), F.col("margin"),
                               F.lit("Actual").alias("data_source"))
    f = star.fact_forecasts.select("date", "date_key", "store_key", "product_key",
                                   F.col("predicted_sales").alias("sales"),
                                   F.col("predicted_revenue").alias("revenue"),
                                   F.col("predicted_margin").alias("margin"),
                                   F.lit("Forecast").alias("data_source"))
    return a.unionByName(f)
