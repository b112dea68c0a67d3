"""Join operators.

No join here forces a broadcast of a data-derived side: Spark's size-based
planning (file statistics against ``autoBroadcastJoinThreshold``) and AQE's
runtime conversion pick a broadcast only when the measured side is small, and
fall back to a shuffle join otherwise.  Sides whose size is fixed by
construction (one-row aggregates, literal lookups) are broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def join_stores(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """JN1: store attributes, left join on ``store_nbr``."""
    return sales.join(stores, "store_nbr", "left")


def join_daily(sales: DataFrame, daily: DataFrame, on: str = "date") -> DataFrame:
    """JN2: a daily external series, left join on the date."""
    return sales.join(daily, on, "left")


def join_holidays(sales: DataFrame, flags: DataFrame) -> DataFrame:
    """JN3: holiday flag, missing dates -> 0."""
    return sales.join(flags, "date", "left").fillna(0, subset=["is_holiday"])


def join_transactions(sales: DataFrame, transactions: DataFrame) -> DataFrame:
    """JN4: composite key (date, store); missing -> 0.0."""
    return (sales.join(transactions, ["date", "store_nbr"], "left")
                 .withColumn("transactions", F.coalesce(F.col("transactions").cast("double"), F.lit(0.0))))


def star_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "left",
              cols: Sequence[str] | None = None) -> DataFrame:
    """JN5 / JN6: fact -> dimension on a shared key."""
    if cols is not None:
        dim = dim.select(key, *[c for c in cols if c != key])
    return fact.join(dim, key, how)


def filter_by_dim(fact: DataFrame, dim_filtered: DataFrame, key: str,
                  dim_key: str | None = None) -> DataFrame:
    """JN7: keep fact rows whose key is in the (filtered) dimension — a semi
    join, so the fact is never widened and duplicates in the dim are harmless."""
    dk = dim_key or key
    keys = dim_filtered.select(F.col(dk).alias("__k"))
    return fact.join(keys, fact[key] == keys["__k"], "left_semi")


def flag_in_dim(fact: DataFrame, dim_filtered: DataFrame, key: str, out: str) -> DataFrame:
    """JN7 as a 0/1 flag (left join on the distinct keys)."""
    keys = dim_filtered.select(F.col(key).alias("__k")).distinct().withColumn("__hit", F.lit(1))
    return (fact.join(keys, fact[key] == keys["__k"], "left")
                .withColumn(out, F.coalesce(F.col("__hit"), F.lit(0)))
                .drop("__k", "__hit"))


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """JN8 / ST-D: distinct fact keys with no row in the dimension."""
    dk = dim_key or key
    keys = fact.select(key).distinct()
    d = dim.select(F.col(dk).alias("__k"))
    return keys.join(d, keys[key] == d["__k"], "left_anti")


def scoring_grid(series: DataFrame, start, horizon: int, keys: Sequence[str] = ("store_nbr", "family")) -> DataFrame:
    """JN12: every forecast date for every series.

    ``series`` holds the series keys (one row per store × family that has
    sales history); ``start`` is the first forecast date (a literal or a
    Column of a one-row frame joined beforehand).  Dates are generated per
    series with ``explode(sequence)`` — a map-side generator, so the grid is
    built without a Cartesian join and its size is series × horizon.
    """
    s = F.to_date(F.lit(start)) if not hasattr(start, "_jc") else start
    dates = F.sequence(s, F.date_add(s, horizon - 1), F.expr("interval 1 day"))
    return series.select(*keys, F.explode(dates).alias("date"))


def apply_context(star, dim_filters: Mapping[str, object]):
    """JN14: a filter on a dimension limits every related fact.

    ``dim_filters`` maps a dimension name (``dim_date``, ``dim_store``,
    ``dim_product``) to a Column predicate.  Each fact is semi-joined with each
    filtered dimension on the shared key; dimensions are filtered too.
    """
    keys = {"dim_date": "date_key", "dim_store": "store_key", "dim_product": "product_key"}
    out = dict(star.tables())
    for dim_name, pred in dim_filters.items():
        if pred is None:
            continue
        fdim = out[dim_name].where(pred)
        out[dim_name] = fdim
        for fact_name in ("fact_sales", "fact_forecasts"):
            fact = out.get(fact_name)
            if fact is None:
                continue
            if dim_name == "dim_date" and "year" in fact.columns:
                # facts stored partitioned by year: a semi join on the
                # partition column lets dynamic partition pruning skip whole
                # year directories before the exact date_key semi join
                fact = filter_by_dim(fact, fdim.select("year").distinct(), "year")
            out[fact_name] = filter_by_dim(fact, fdim, keys[dim_name])
    return star.replace(**out)
