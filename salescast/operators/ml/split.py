"""ML3: time split — train on rows up to max(date) - days, test on the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions import fixed


def cutoff(df: DataFrame, days: int = fixed.HOLDOUT_DAYS, date_col: str = "date"):
    """The cutoff date as a scalar subquery (no collect)."""
    return F.date_sub(df.agg(F.max(date_col)).scalar(), days)


def time_split(df: DataFrame, days: int = fixed.HOLDOUT_DAYS, date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    c = cutoff(df, days, date_col)
    return df.where(F.col(date_col) <= c), df.where(F.col(date_col) > c)


def split_summary(df: DataFrame, days: int = fixed.HOLDOUT_DAYS) -> DataFrame:
    """Rows and date range of each side of the split."""
    c = cutoff(df, days)
    side = F.when(F.col("date") <= c, F.lit("train")).otherwise(F.lit("test"))
    return df.groupBy(side.alias("split")).agg(F.count(F.lit(1)).alias("rows"),
                                                 F.min("date").alias("first_date"),
                                                 F.max("date").alias("last_date"))
