"""BI measures as DataFrame operators.

A measure is evaluated at a grain (``by``: dimension attributes) inside a
filter context (``where``: dimension -> predicate, see ``joins.apply_context``).
Rules kept from the BI semantics: SUM over no rows is NULL (BLANK); BLANK in
+/- acts as 0; DIVIDE by 0 or BLANK is NULL.  Measures are aggregate-then-join:
each fact is aggregated to the grain first, and facts meet only at the grain.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.functions import calendar as cal
from salescast.functions import fixed
from salescast.operators import joins
from salescast.session import materialize

DIM_OF = {
    "category": "dim_product", "family": "dim_product",
    "store_type": "dim_store", "city": "dim_store", "state": "dim_store", "region": "dim_store",
    "cluster": "dim_store", "store_nbr": "dim_store",
    "date": "dim_date", "year": "dim_date", "quarter": "dim_date", "month": "dim_date",
    "year_month": "dim_date", "day_of_week": "dim_date", "month_name": "dim_date",
    "is_holiday": "dim_date", "is_weekend": "dim_date", "week_of_year": "dim_date",
}
KEY_OF = {"dim_product": "product_key", "dim_store": "store_key", "dim_date": "date_key"}
FACT_COLS = {"revenue": ("fact_sales", "revenue"), "units": ("fact_sales", "sales"),
             "margin": ("fact_sales", "margin"), "transactions": ("fact_sales", "transactions"),
             "forecast_revenue": ("fact_forecasts", "predicted_revenue"),
             "forecast_units": ("fact_forecasts", "predicted_sales"),
             "forecast_margin": ("fact_forecasts", "predicted_margin")}

_REGISTRY: dict[str, Callable] = {}


def register_measure(name: str, fn: Callable) -> None:
    """Extension point: ``fn(star_frame) -> Column`` aggregate over the
    fact joined with its dimensions."""
    _REGISTRY[name] = fn


def with_dims(star, fact: str, by: Sequence[str]) -> DataFrame:
    """The fact joined with the dimensions that ``by`` needs (only those)."""
    t = star.tables()
    df = t[fact]
    need: dict[str, list[str]] = {}
    for c in by:
        if c in df.columns:
            continue
        need.setdefault(DIM_OF[c], []).append(c)
    for dim, cols in need.items():
        df = joins.star_join(df, t[dim], KEY_OF[dim], cols=cols)
    return df


def total(star, measure: str = "revenue", by: Sequence[str] = (), where: Mapping | None = None,
          out: str | None = None) -> DataFrame:
    """ME1–3, ME12–13: SUM of a fact column at the grain ``by``."""
    if where:
        star = joins.apply_context(star, where)
    fact, col = FACT_COLS[measure]
    df = with_dims(star, fact, by)
    agg = F.sum(col)
    if measure in _REGISTRY:
        agg = _REGISTRY[measure](df)
    elif col in ("revenue", "margin", "predicted_revenue", "predicted_margin"):
        agg = agg.cast("double")
    return df.groupBy(*by).agg(agg.alias(out or measure))


def custom(star, name: str, fact: str = "fact_sales", by: Sequence[str] = ()) -> DataFrame:
    df = with_dims(star, fact, by)
    return df.groupBy(*by).agg(_REGISTRY[name](df).alias(name))


# ME4 -------------------------------------------------------------------------
def yoy(star, grain: str = "month", by: Sequence[str] = (), measure: str = "revenue") -> DataFrame:
    """Revenue and the same period last year, growth = (cur - prev) / prev.

    The rows are the calendar periods of ``dim_date`` (× ``by`` values seen in
    the fact); ``cur`` is NULL for periods without sales, and is taken as 0 in
    the numerator; growth is NULL when the prior period is NULL or 0.
    ``grain``: ``year``, ``month`` (prior = same month a year earlier) or
    ``date`` (prior = the date 12 months earlier, 29 Feb -> 28 Feb).
    """
    fact, col = FACT_COLS[measure]
    periods = {"year": ["year"], "month": ["year", "month"], "date": ["date"]}[grain]
    df = with_dims(star, fact, [*periods, *by] if grain != "date" else ["date", *by])
    # written once: current and prior values are both read from it
    cur = materialize(df.groupBy(*periods, *by).agg(F.sum(col).alias("cur")), name="yoy")
    prev_keys = {"year": [(F.col("year") + 1).alias("year")],
                 "month": [(F.col("year") + 1).alias("year"), F.col("month")],
                 "date": None}[grain]
    if grain == "date":
        # every date maps to its prior-year date; a year later two dates can
        # share one prior date (29 Feb and 28 Feb both map to 28 Feb)
        cal_rows = star.dim_date.select("date", F.add_months("date", -12).alias("prior_date"))
        prev = (cur.join(cal_rows.select(F.col("date").alias("__p"), "prior_date"),
                         F.col("date") == F.col("prior_date"))
                   .select(F.col("__p").alias("date"), *by, F.col("cur").alias("prev")))
        spine = star.dim_date.select("date")
    else:
        prev = cur.select(*prev_keys, *by, F.col("cur").alias("prev"))
        spine = star.dim_date.select(*periods).distinct()
    keys = periods + list(by)
    if by:
        # periods × by values that have a current or a prior-year value
        rows = cur.select(*keys).unionByName(prev.select(*keys)).distinct()
        rows = rows.join(spine, periods, "left_semi")
    else:
        rows = spine
    out = rows.join(cur, keys, "left").join(prev, keys, "left")
    # exact (decimal) difference, then one IEEE division: no intermediate
    # decimal rounding before the final round to 6 places
    growth = F.try_divide((F.coalesce(F.col("cur"), F.lit(0)) - F.col("prev")).cast("double"),
                          F.col("prev").cast("double"))
    money = col in ("revenue", "margin", "predicted_revenue", "predicted_margin")
    conv = (lambda c: c.cast("double")) if money else (lambda c: c)
    return out.select(*keys, conv(F.col("cur")).alias("current"), conv(F.col("prev")).alias("prior_year"),
                      F.round(conv(growth), 6).alias("yoy_growth"))


# ME5 / ME6 -------------------------------------------------------------------
def to_date_total(star, period: str = "year", by: Sequence[str] = (), measure: str = "revenue") -> DataFrame:
    """Running total from the start of the year (``year``) or month (``month``)
    up to each date.  Without ``by`` every calendar day of ``dim_date`` has a
    row; with ``by`` the (date, by) pairs that have sales.  Each window
    partition is one period × one ``by`` value, so it is calendar-bounded."""
    fact, col = FACT_COLS[measure]
    df = with_dims(star, fact, by)
    daily = df.groupBy("date_key", *by).agg(F.sum(col).alias("__v"))
    if not by:
        daily = star.dim_date.select("date_key").join(daily, "date_key", "left")
    daily = daily.withColumn("date", cal.from_date_key("date_key"))
    part = [F.year("date")] + ([F.month("date")] if period == "month" else [])
    w = (Window.partitionBy(*part, *by).orderBy("date_key")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    name = "ytd" if period == "year" else "mtd"
    v = F.sum("__v").over(w)
    if col in ("revenue", "margin", "predicted_revenue", "predicted_margin"):
        v = v.cast("double")
    return daily.select("date", *by, v.alias(f"{measure}_{name}"))


# ME7 -------------------------------------------------------------------------
def match_forecasts(star) -> DataFrame:
    """JN10: each actual row with the summed prediction of the same
    (date, store, product) — an inner equi-join on three keys, forecasts
    aggregated to the key first."""
    k = ["date_key", "store_key", "product_key"]
    fc = star.fact_forecasts.groupBy(*k).agg(F.sum("predicted_sales").alias("predicted"))
    # only days that have forecasts are read from the actuals
    days = star.fact_forecasts.agg(F.min("date_key").alias("lo"), F.max("date_key").alias("hi"))
    actual = star.fact_sales.where(F.col("date_key").between(days.select("lo").scalar(), days.select("hi").scalar()))
    return actual.select(*k, "sales").join(fc, k, "inner")


def mape_bi(star, by: Sequence[str] = ()) -> DataFrame:
    """MAPE as the BI measure: Σ |a − p| / |a| over matched rows, divided by
    the number of matched rows (zero actuals add nothing but are counted),
    × 100; NULL when nothing matches."""
    m = match_forecasts(star)
    t = star.tables()
    for c in by:
        m = joins.star_join(m, t[DIM_OF[c]], KEY_OF[DIM_OF[c]], cols=[c])
    ape = F.try_divide(F.abs(F.col("sales") - F.col("predicted")), F.abs(F.col("sales")))
    return m.groupBy(*by).agg(
        F.round(F.try_divide(F.sum(ape), F.count(F.lit(1))) * 100, 6).alias("mape"),
        F.count(F.lit(1)).alias("matched_rows"))


# ME8 / ME9 -------------------------------------------------------------------
def pct_of_total(star, by: Sequence[str], measure: str = "revenue", where: Mapping | None = None,
                 respect_filters: bool = False) -> DataFrame:
    """Share of the grand total.  The groups are evaluated in the filter
    context ``where``; the denominator ignores every filter (``ALL`` on the
    fact also clears filters arriving from dimensions, Q13) unless
    ``respect_filters=True``."""
    fact, col = FACT_COLS[measure]
    ctx = joins.apply_context(star, where) if where else star
    per = with_dims(ctx, fact, by).groupBy(*by).agg(F.sum(col).alias("__v"))
    same = not where or respect_filters  # then the groups add up to the total
    grand = (per.agg(F.sum("__v")) if same else star.tables()[fact].agg(F.sum(col))).scalar()
    return per.select(*by, F.col("__v").cast("double").alias(measure),
                      F.round(F.try_divide(F.col("__v").cast("double"), grand.cast("double")), 6)
                      .alias("pct_of_total"))


def pct_of_category(star, by: Sequence[str] = ("family",), measure: str = "revenue") -> DataFrame:
    """Share within the product category, keeping the other ``by`` keys."""
    fact, col = FACT_COLS[measure]
    keys = list(dict.fromkeys(["category", *by]))
    per = with_dims(star, fact, keys).groupBy(*keys).agg(F.sum(col).alias("__v"))
    others = [k for k in keys if DIM_OF.get(k) != "dim_product"]
    w = Window.partitionBy("category", *others)
    return per.select(*keys, F.col("__v").cast("double").alias(measure),
                      F.round(F.try_divide(F.col("__v").cast("double"), F.sum("__v").over(w).cast("double")), 6)
                      .alias("pct_of_category"))


# ME10 / ME11 / ME15 ----------------------------------------------------------
def selected_metric(star, metric: str | None = "Revenue", by: Sequence[str] = (),
                    forecast: bool = False) -> DataFrame:
    """The slicer-chosen measure; unknown or no selection -> Revenue."""
    name = {"Revenue": "revenue", "Units": "units", "Margin": "margin"}.get(metric or "Revenue", "revenue")
    if forecast:
        name = "forecast_" + name
    return total(star, name, by, out="selected_metric")


def selected_metric_table(star, by: Sequence[str] = (), selections=None) -> DataFrame:
    """ME10 for several slicer selections at once: one pass computes the three
    measures, then one row per (selection, grain) picks its measure (an
    unknown or empty selection means Revenue)."""
    selections = selections or [*fixed.METRIC_SELECTOR, None]
    df = with_dims(star, "fact_sales", by)
    per = df.groupBy(*by).agg(F.sum("revenue").cast("double").alias("Revenue"),
                              F.sum("sales").cast("double").alias("Units"),
                              F.sum("margin").cast("double").alias("Margin"))
    rows = [F.struct(F.lit(sel if sel is not None else "(none)").alias("metric"),
                     F.col(sel if sel in fixed.METRIC_SELECTOR else "Revenue").alias("selected_metric"))
            for sel in selections]
    return per.select(*by, F.inline(F.array(*rows))).select("metric", *by, "selected_metric")


def metric_selector(spark) -> DataFrame:
    return spark.createDataFrame([(m,) for m in fixed.METRIC_SELECTOR], "Metric string")


# ME14 ------------------------------------------------------------------------
def forecast_variance(star, by: Sequence[str]) -> DataFrame:
    """(F − A) / A at the shared grain; both facts aggregated first, then a
    full outer join on ``by`` (BLANK forecast counts as 0)."""
    if by:
        a = with_dims(star, "fact_sales", by).groupBy(*by).agg(F.sum("revenue").alias("a"))
        f = with_dims(star, "fact_forecasts", by).groupBy(*by).agg(F.sum("predicted_revenue").alias("f"))
        j = a.join(f, list(by), "full")
    else:
        # grand totals: both facts in one pass, no key-less join
        none = F.lit(None).cast("decimal(18,4)")
        both = (star.fact_sales.select(F.col("revenue").alias("a"), none.alias("f"))
                .unionByName(star.fact_forecasts.select(none.alias("a"), F.col("predicted_revenue").alias("f"))))
        j = both.agg(F.sum("a").alias("a"), F.sum("f").alias("f"))
    var = F.try_divide((F.coalesce(F.col("f"), F.lit(0)) - F.col("a")).cast("double"), F.col("a").cast("double"))
    return j.select(*by, F.col("a").cast("double").alias("actual_revenue"),
                    F.col("f").cast("double").alias("forecast_revenue"),
                    F.round(var.cast("double"), 6).alias("variance"))


# ME16 / ME17 -----------------------------------------------------------------
def yoy_colour(yoy_df: DataFrame) -> DataFrame:
    return yoy_df.withColumn("yoy_colour", cal.yoy_colour("yoy_growth"))


def mape_status(mape_df: DataFrame, blank_as_zero: bool = False) -> DataFrame:
    return mape_df.withColumn("mape_status", cal.mape_status("mape", blank_as_zero))


# ME18 ------------------------------------------------------------------------
def revenue_per_transaction(star, by: Sequence[str] = (), dedup: bool = False) -> DataFrame:
    """Revenue / transactions.  As written the transaction count repeats on
    every product row of a (date, store); ``dedup=True`` counts each
    (date, store) once."""
    df = with_dims(star, "fact_sales", by)
    r, t = F.sum("revenue").alias("r"), F.sum("transactions").alias("t")
    if dedup:  # one row a (date, store) first, in the same pass
        df = df.groupBy("date_key", "store_key", *by).agg(r, F.max("transactions").alias("transactions"))
        r = F.sum("r").alias("r")
    return df.groupBy(*by).agg(r, t).select(*by, F.round(F.try_divide(F.col("r").cast("double"), F.col("t")), 6)
                                            .alias("revenue_per_transaction"))


# ME19 ------------------------------------------------------------------------
def matrix_check(star, year: int, by: str = "family") -> DataFrame:
    """Actual and forecast revenue per family under a year filter that
    reaches both facts through ``dim_date``."""
    s = joins.apply_context(star, {"dim_date": F.col("year") == year})
    return forecast_variance(s, [by]).drop("variance")
