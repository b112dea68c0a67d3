"""Cleaning, projection and lookup operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.functions import calendar as cal
from salescast.functions import fixed


def literal_map(mapping: Mapping, value_type: str | None = None) -> Column:
    """A small fixed lookup as a literal map column (no join, no shuffle).

    Only for fixed tables of code-defined size (the lookups in ``fixed``).
    """
    items = []
    for k, v in mapping.items():
        items.append(F.lit(k))
        items.append(F.lit(v).cast(value_type) if value_type else F.lit(v))
    return F.create_map(*items)


def lookup(col, mapping: Mapping, default=None, value_type: str | None = None) -> Column:
    """PR4 as a column: ``mapping[col]`` with a default for unknown or NULL keys."""
    c = F.col(col) if isinstance(col, str) else col
    found = F.try_element_at(literal_map(mapping, value_type), c)
    if default is None:
        return found
    dflt = F.lit(default).cast(value_type) if value_type else F.lit(default)
    return F.coalesce(found, dflt)


def map_with_default(df: DataFrame, col: str, table, out: str, default,
                     key: str | None = None, value: str | None = None) -> DataFrame:
    """PR4: lookup with default.

    ``table`` is either a fixed dict (becomes a literal map) or a lookup
    DataFrame ``(key, value)``; the latter is left-joined and Spark chooses
    the join strategy from its size (auto/AQE broadcast when small).
    """
    if isinstance(table, Mapping):
        return df.withColumn(out, lookup(col, table, default))
    key = key or table.columns[0]
    value = value or table.columns[1]
    lk = table.select(F.col(key).alias("__lk_key"), F.col(value).alias("__lk_val"))
    joined = df.join(lk, df[col].eqNullSafe(lk["__lk_key"]), "left")
    return joined.withColumn(out, F.coalesce(F.col("__lk_val"), F.lit(default))).drop("__lk_key", "__lk_val")


def clip_lower(df: DataFrame, col: str, lower=0) -> DataFrame:
    """PR1: negatives become ``lower``; NULL stays NULL."""
    return df.withColumn(col, cal.clip_lower(col, lower))


def holiday_flags(holidays: DataFrame) -> DataFrame:
    """PR3 + AG11: one row per date; 1 if any event on it was not transferred."""
    return (holidays.select("date", (~F.col("transferred")).cast("int").alias("is_holiday"))
                    .groupBy("date").agg(F.max("is_holiday").alias("is_holiday")))


def fill_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PR12: NULL -> 0 on the given columns."""
    return df.fillna(0, subset=list(cols))


def align_columns(df: DataFrame, cols: Iterable[str], value=0) -> DataFrame:
    """PR14: make sure every column exists; missing ones are the constant ``value``."""
    missing = {c: F.lit(value) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def where_eq(df: DataFrame, col: str, value) -> DataFrame:
    """PR16: equality filter, the value "All" (or None) means no filter."""
    if value is None or value == "All":
        return df
    return df.where(F.col(col) == F.lit(value))


def category_col(family="family", family_to_category: Mapping | None = None) -> Column:
    return lookup(family, family_to_category or fixed.FAMILY_TO_CATEGORY, fixed.DEFAULT_CATEGORY)


def price_col(category="category", prices: Mapping | None = None) -> Column:
    return lookup(category, prices or fixed.AVG_PRICES, fixed.DEFAULT_PRICE, "decimal(6,2)")


def margin_rate_col(category="category", rates: Mapping | None = None) -> Column:
    return lookup(category, rates or fixed.MARGIN_RATES, fixed.DEFAULT_MARGIN_RATE, "decimal(6,2)")


def add_revenue_margin(df: DataFrame, units: str = "sales", category: str = "category",
                       prices: Mapping | None = None, rates: Mapping | None = None) -> DataFrame:
    """PR6: revenue = units × unit price; margin = revenue × rate.  Neither is
    rounded: units of up to six places give eight and ten."""
    revenue = (F.col(units).cast("decimal(22,6)") * price_col(category, prices)).cast("decimal(29,8)")
    return (df.withColumn("revenue", revenue)
              .withColumn("margin", (F.col("revenue") * margin_rate_col(category, rates)).cast("decimal(36,10)")))


def post_process(df: DataFrame, col: str = "prediction", out: str | None = None) -> DataFrame:
    """PR15: clip at 0 and round half to even to whole units."""
    return df.withColumn(out or col, cal.post_process(col))


def build_dim_store(features: DataFrame, state_to_region: Mapping | None = None) -> DataFrame:
    """PR19 + PR4 (SB4): distinct stores, surrogate key, region."""
    return (features.select("store_nbr", "city", "state", "type", "cluster")
                    .dropDuplicates()
                    .withColumnRenamed("type", "store_type")
                    .withColumn("store_key", F.col("store_nbr"))
                    .withColumn("region", lookup("state", state_to_region or fixed.STATE_TO_REGION,
                                                 fixed.DEFAULT_REGION))
                    .select("store_nbr", "city", "state", "store_type", "cluster", "store_key", "region"))
