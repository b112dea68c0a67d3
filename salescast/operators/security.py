"""Row-level security.

A role is a predicate on ``dim_store.region``; it reaches both facts through
semi joins on ``store_key`` (``joins.apply_context``).  A user sees the union
of the regions of their roles; a user with no role sees nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions import fixed
from salescast.operators import joins


def secure(star, role: str, roles: Mapping[str, str | None] | None = None):
    """RL1 / RL2: the star as seen by one role ("All" = unfiltered)."""
    roles = roles or fixed.ROLES
    if role not in roles:
        raise KeyError(f"unknown role {role!r}")
    region = roles[role]
    if region is None:
        return star
    return joins.apply_context(star, {"dim_store": F.col("region") == region})


def roles_frame(spark, roles: Mapping[str, str | None] | None = None) -> DataFrame:
    roles = roles or fixed.ROLES
    return spark.createDataFrame(list(roles.items()), "role string, region string")


def secure_for(star, user: str, grants: DataFrame, roles: DataFrame):
    """RL3: ``grants`` (user, role) and ``roles`` (role, region; NULL region =
    all regions).  The allowed stores are the stores in the user's regions,
    plus every store when one of the user's roles is unrestricted."""
    mine = grants.where(F.col("user") == user).join(roles, "role")
    regions = mine.where(F.col("region").isNotNull()).select("region")
    has_all = mine.agg(F.count_if(F.col("region").isNull()) > 0).scalar()
    stores = star.dim_store
    allowed = (stores.join(regions, "region", "left_semi")
                     .unionByName(stores.where(has_all))
                     .select("store_key").distinct())
    out = dict(star.tables())
    out["dim_store"] = stores.join(allowed, "store_key", "left_semi")
    for fact in ("fact_sales", "fact_forecasts"):
        if out.get(fact) is not None:
            out[fact] = joins.filter_by_dim(out[fact], allowed, "store_key")
    return star.replace(**out)


def user_totals(star, users: DataFrame, grants: DataFrame, roles: DataFrame) -> DataFrame:
    """RL3 for all of ``users`` (user) in one plan: each fact is reduced to
    its stores once and then joined to the (user, store) pairs that the users'
    roles allow.  (user, revenue, forecast_revenue, stores)."""
    mine = grants.distinct().join(roles, "role").select("user", "region").distinct()
    stores = star.dim_store.select("store_key", "region")
    allowed = mine.where("region is not null").join(stores, "region").select("user", "store_key")
    # an unrestricted role allows the stores of every region
    regions = stores.agg(F.collect_set("region")).scalar()
    every = mine.where("region is null").select("user", F.explode(regions).alias("region")).join(stores, "region").select("user", "store_key")
    allowed = allowed.unionByName(every).distinct()
    a = star.fact_sales.groupBy("store_key").agg(F.sum("revenue").alias("revenue"))
    f = star.fact_forecasts.groupBy("store_key").agg(F.sum("predicted_revenue").alias("forecast_revenue"))
    seen = (allowed.join(a, "store_key", "left").join(f, "store_key", "left").groupBy("user")
            .agg(F.sum("revenue").cast("double").alias("revenue"), F.sum("forecast_revenue").cast("double").alias("forecast_revenue"),
                 F.count("*").alias("stores")))
    return users.join(seen, "user", "left").select("user", "revenue", "forecast_revenue", F.coalesce("stores", F.lit(0)).alias("stores"))


def role_kpis(star, roles: Mapping[str, str | None] | None = None) -> DataFrame:
    """RL1 for every regional role in one pass per fact: both facts are
    aggregated by the region of their store, then each role takes its
    region's totals (the same numbers ``secure(star, role)`` gives)."""
    roles = roles or fixed.ROLES
    spark = star.fact_sales.sparkSession
    regional = [(r, g) for r, g in roles.items() if g is not None]
    role_df = spark.createDataFrame(regional, "role string, region string")
    stores = star.dim_store.select("store_key", "region")
    a = (star.fact_sales.join(stores, "store_key").groupBy("region")
         .agg(F.sum("revenue").cast("double").alias("total_revenue"), F.sum("sales").alias("total_units")))
    out = role_df.join(a, "region", "left")
    if star.fact_forecasts is not None:
        f = (star.fact_forecasts.join(stores, "store_key").groupBy("region")
             .agg(F.sum("predicted_revenue").cast("double").alias("forecast_revenue"),
                  F.sum("predicted_sales").alias("forecast_units"),
                  F.sum("predicted_margin").cast("double").alias("forecast_margin")))
        out = out.join(f, "region", "left")
    return out.drop("region")


def stores_by_region(dim_store: DataFrame) -> DataFrame:
    """RL4: number of stores per region."""
    return dim_store.groupBy("region").agg(F.count(F.lit(1)).alias("stores"))
