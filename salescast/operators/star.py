"""Raw tables -> features -> star schema.

Plans are lazy; nothing here collects.  ``build_star`` returns a ``Star``
whose tables share the ``features`` lineage — callers that write several
outputs should persist / write ``features`` once (see ``plans.prepare``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace as dc_replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions import calendar as cal
from salescast.operators import clean, joins, timeseries as ts

SERIES_KEYS = ["store_nbr", "family"]


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_store: DataFrame
    dim_product: DataFrame
    fact_sales: DataFrame
    fact_forecasts: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def replace(self, **kw) -> "Star":
        return dc_replace(self, **kw)


# SB1 -------------------------------------------------------------------------
def clean_oil(oil: DataFrame, extra_dates: DataFrame | None = None) -> DataFrame:
    """Daily oil series: resample to days (gap days inserted), forward fill,
    back fill, rename to ``oil_price``.

    ``extra_dates`` widens the daily range to every date the sales use, so the
    later join never misses; before the first quote the first price applies and
    after the last quote the last one (the same values a fill after the join
    gives on date-sorted input).  The frame is daily, so its window runs over
    a calendar-bounded number of rows.
    """
    daily = ts.densify_daily(oil, ["dcoilwtico"], "date", extra_dates)
    return ts.fill_series(daily, "dcoilwtico", None, "date").withColumnRenamed("dcoilwtico", "oil_price")


def load_raw(raw: Mapping[str, DataFrame], holiday_filter=None) -> dict[str, DataFrame]:
    """SB1: clean the five raw tables.

    train: negative sales clipped to 0 (NULL kept); oil: daily, filled;
    holidays: one 0/1 flag per date — every non-transferred event counts,
    whatever its locale or type (Q4), unless ``holiday_filter`` (a Column
    predicate over the raw events, e.g. national events only) narrows them;
    stores / transactions unchanged.
    """
    train = clean.clip_lower(raw["train"], "sales", 0.0)
    hol = raw["holidays"] if holiday_filter is None else raw["holidays"].where(holiday_filter)
    return {
        "train": train,
        "stores": raw["stores"],
        "oil": clean_oil(raw["oil"], train.select("date")),
        "holidays": clean.holiday_flags(hol),
        "transactions": raw["transactions"],
    }


# SB2 -------------------------------------------------------------------------
FEATURE_ORDER = ["date", "store_nbr", "family", "sales", "onpromotion", "city", "state", "type",
                 "cluster", "oil_price", "is_holiday", "transactions", "year", "month",
                 "day_of_week", "day_of_month", "week_of_year", "quarter", "is_weekend",
                 "is_payday", "is_month_start", "oil_price_lag7"]


def features(data: Mapping[str, DataFrame], lag: int = 7) -> DataFrame:
    """SB2: the flat feature table, one row per (date, store, family).

    Joins: stores (left, on store), oil (left, on date), holiday flags (left,
    NULL -> 0), transactions (left, on date and store, NULL -> 0).  Calendar
    columns are column expressions.  The oil lag counts rows within a series
    and back-fills the leading rows from the same series only.
    """
    df = joins.join_stores(data["train"], data["stores"])
    df = joins.join_daily(df, data["oil"].select("date", "oil_price"))
    df = joins.join_holidays(df, data["holidays"])
    df = joins.join_transactions(df, data["transactions"])
    df = df.withColumns(cal.calendar_features("date"))
    df = ts.lag_rows(df, "oil_price", lag, SERIES_KEYS, "date", out="oil_price_lag7")
    df = ts.bfill(df, "oil_price_lag7", SERIES_KEYS, "date")
    return df.select(*FEATURE_ORDER)


# SB3 -------------------------------------------------------------------------
DIM_DATE_ORDER = ["date", "date_key", "year", "quarter", "month", "month_name", "week_of_year",
                  "day_of_week", "day_name", "day_of_month", "is_weekend", "fiscal_year",
                  "year_month", "year_quarter", "is_holiday"]


def build_dim_date(df: DataFrame, extend_days: int = 0) -> DataFrame:
    """SB3: one row per day from the first to the last date (plus
    ``extend_days``), 15 calendar columns, ``is_holiday`` from the data."""
    bounds = df.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    spine = ts.date_spine(bounds, F.col("lo"), F.date_add(F.col("hi"), extend_days), "date")
    d = "date"
    dim = spine.select(
        F.col(d),
        cal.date_key(d).alias("date_key"),
        cal.year(d).alias("year"),
        cal.quarter(d).alias("quarter"),
        cal.month(d).alias("month"),
        cal.month_name(d).alias("month_name"),
        cal.week_of_year(d).alias("week_of_year"),
        cal.day_of_week(d).alias("day_of_week"),
        cal.day_name(d).alias("day_name"),
        cal.day_of_month(d).alias("day_of_month"),
        cal.is_weekend(d).alias("is_weekend"),
        cal.fiscal_year(d).alias("fiscal_year"),
        cal.year_month(d).alias("year_month"),
        cal.year_quarter(d).alias("year_quarter"),
    )
    holiday_dates = df.where(F.col("is_holiday") == 1).select("date")
    return joins.flag_in_dim(dim, holiday_dates, "date", "is_holiday").select(*DIM_DATE_ORDER)


# SB4 -------------------------------------------------------------------------
def build_dim_store(df: DataFrame, state_to_region: Mapping | None = None) -> DataFrame:
    return clean.build_dim_store(df, state_to_region)


# SB5 -------------------------------------------------------------------------
def build_dim_product(df: DataFrame, family_to_category: Mapping | None = None, registry=None) -> DataFrame:
    """SB5: ``product_key`` = 1-based position of the family in sorted order
    (distributed dense numbering, ``operators.keys``).  With a ``KeyRegistry``
    families keep the keys they have, and new ones get the next."""
    from salescast.operators.keys import dense_keys
    keyed = (registry.refresh(df, "family").select(F.col("value").alias("family"), F.col("key").alias("product_key"))
             if registry else dense_keys(df, "family", "product_key", start=1))
    return (keyed.withColumn("category", clean.category_col("family", family_to_category))
            .select("product_key", "family", "category"))


# SB6 -------------------------------------------------------------------------
FACT_SALES_ORDER = ["date", "sales", "onpromotion", "oil_price", "is_holiday", "transactions",
                    "date_key", "store_key", "product_key", "revenue", "margin"]


def build_fact_sales(df: DataFrame, dim_product: DataFrame,
                     family_to_category: Mapping | None = None,
                     prices: Mapping | None = None, rates: Mapping | None = None) -> DataFrame:
    """SB6: keys, money columns (exact decimals), helper columns dropped."""
    fact = (df.select("date", "store_nbr", "family", "sales", "onpromotion", "oil_price",
                      "is_holiday", "transactions")
              .withColumn("date_key", cal.date_key("date"))
              .withColumn("store_key", F.col("store_nbr")))
    fact = fact.join(dim_product.select("family", "product_key"), "family", "left")
    fact = fact.withColumn("category", clean.category_col("family", family_to_category))
    fact = clean.add_revenue_margin(fact, "sales", "category", prices, rates)
    return fact.select(*FACT_SALES_ORDER)


# SB7 -------------------------------------------------------------------------
def build_star(df: DataFrame, family_to_category: Mapping | None = None,
               state_to_region: Mapping | None = None, extend_days: int = 0) -> Star:
    dim_product = build_dim_product(df, family_to_category)
    return Star(
        dim_date=build_dim_date(df, extend_days),
        dim_store=build_dim_store(df, state_to_region),
        dim_product=dim_product,
        fact_sales=build_fact_sales(df, dim_product, family_to_category),
    )


# SB8 -------------------------------------------------------------------------
def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """AG21: per table — rows, columns, null % over all cells (one pass each)."""
    parts = []
    for name, t in tables.items():
        ncols = len(t.columns)
        nulls = sum((F.sum(F.col(c).isNull().cast("long")) for c in t.columns), F.lit(0))
        parts.append(t.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("null_cells"))
                      .select(F.lit(name).alias("table"), "rows", F.lit(ncols).alias("columns"),
                              F.round(F.coalesce(F.try_divide(F.col("null_cells") * 100.0,
                                                              F.col("rows") * ncols), F.lit(0.0)), 6)
                              .alias("null_pct")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def column_nulls(df: DataFrame) -> DataFrame:
    """AG21: null count per column, one aggregation pass, unpivoted."""
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    return agg.unpivot([], df.columns, "column", "nulls")


def integrity(star: Star) -> DataFrame:
    """SB8: orphan keys per fact -> dimension relation (table, key, orphans)."""
    rels = [("fact_sales", "date_key", "dim_date"), ("fact_sales", "store_key", "dim_store"),
            ("fact_sales", "product_key", "dim_product")]
    if star.fact_forecasts is not None:
        rels += [("fact_forecasts", "date_key", "dim_date"), ("fact_forecasts", "store_key", "dim_store"),
                 ("fact_forecasts", "product_key", "dim_product")]
    t = star.tables()
    out = None
    for fact, key, dim in rels:
        part = (joins.orphan_keys(t[fact], t[dim], key)
                .agg(F.count(F.lit(1)).alias("orphans"))
                .select(F.lit(fact).alias("fact"), F.lit(key).alias("key"), F.lit(dim).alias("dim"), "orphans"))
        out = part if out is None else out.unionByName(part)
    return out
