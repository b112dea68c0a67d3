"""Windows and time-series shaping.

Row-level windows are always partitioned by a series key.  The sales table has
at most one row per (series, day), so one window partition holds at most one
row per calendar day whatever the data volume.  Series without a key are filled, averaged and
ranked over range partitions with what the ones before carry over, so they may
be of any length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.operators.keys import global_rank, number_rows
from salescast.session import materialize

U_PREC = Window.unboundedPreceding
U_FOLL = Window.unboundedFollowing


def _w(keys: Sequence[str] | None, order: str | Column):
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return w.orderBy(order)


def lag_rows(df: DataFrame, col: str, n: int, keys: Sequence[str], order: str = "date",
             out: str | None = None) -> DataFrame:
    """WN1: value ``n`` rows earlier within the series (rows, not days)."""
    return df.withColumn(out or f"{col}_lag{n}", F.lag(col, n).over(_w(keys, order)))


def lag_days(df: DataFrame, col: str, n: int, keys: Sequence[str], date_col: str = "date",
             out: str | None = None) -> DataFrame:
    """WN1, day mode: the value ``n`` calendar days earlier in the same series
    (NULL when that day has no row) — an equi-join on (keys, date - n), so a
    long series is never gathered into one window partition."""
    prev = df.select(*keys, F.date_add(F.col(date_col), n).alias(date_col), F.col(col).alias(out or f"{col}_lag{n}d"))
    return df.join(prev, [*keys, date_col], "left")


def ffill_col(col: str, keys: Sequence[str] | None, order: str = "date") -> Column:
    """Last non-NULL value at or before the row (running frame, O(n))."""
    return F.last(col, ignorenulls=True).over(_w(keys, F.col(order).asc()).rowsBetween(U_PREC, 0))


def bfill_col(col: str, keys: Sequence[str] | None, order: str = "date") -> Column:
    """First non-NULL value at or after the row.

    Written as a running frame over the reversed order, so each row costs O(1)
    instead of re-scanning an unbounded-following frame.
    """
    return F.last(col, ignorenulls=True).over(_w(keys, F.col(order).desc()).rowsBetween(U_PREC, 0))


def bfill(df: DataFrame, col: str, keys: Sequence[str] | None, order: str = "date") -> DataFrame:
    """WN2: back-fill leading NULLs (and any NULL) within the series."""
    return df.withColumn(col, F.coalesce(F.col(col), bfill_col(col, keys, order)))


def fill_series(df: DataFrame, col: str, keys: Sequence[str] | None = None,
                order: str | Sequence[str] = "date", partitions: int | None = None) -> DataFrame:
    """WN3: forward fill, then back fill what is still NULL.  Without ``keys``
    the whole frame is one series, filled over range partitions."""
    if not keys:
        return carry_fill(df, col, [order] if isinstance(order, str) else order, partitions)
    filled = df.withColumn("__ff", F.coalesce(F.col(col), ffill_col(col, keys, order)))
    return (filled.withColumn(col, F.coalesce(F.col("__ff"), bfill_col("__ff", keys, order)))
                  .drop("__ff"))


def carry_fill(df: DataFrame, col: str, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """WN3 for one series of any length: filled inside range partitions, then
    from the last value of the partitions before, then from the first value of
    those after (one row a partition each).  ``order`` should be total."""
    cols = [F.col(o) for o in order]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = materialize(ranged.withColumn("__pid", F.spark_partition_id()), df.sparkSession, "ranges")
    inside = Window.partitionBy("__pid")
    last = F.last(col, ignorenulls=True).over(inside.orderBy(*cols).rowsBetween(U_PREC, 0))
    has = F.when(F.col(col).isNotNull(), F.struct(*order))
    ends = ranged.groupBy("__pid").agg(F.max_by(col, has).alias("__last"), F.min_by(col, has).alias("__first"))
    carried = ends.select("__pid", F.last("__last", ignorenulls=True).over(Window.orderBy("__pid").rowsBetween(U_PREC, -1)).alias("__before"),
                          F.first("__first", ignorenulls=True).over(Window.orderBy("__pid").rowsBetween(0, U_FOLL)).alias("__after"))
    # where nothing lies before, the series begins in this partition or a later one: its first value fills
    filled = ranged.withColumn("__ff", last).join(F.broadcast(carried), "__pid")  # one row a partition
    return filled.withColumn(col, F.coalesce("__ff", "__before", "__after")).select(*df.columns)


def date_spine(spark_or_df, start, end, name: str = "date") -> DataFrame:
    """WN5: one row per day from ``start`` to ``end`` inclusive.

    ``start`` / ``end`` may be literals (str / date) or columns of a one-row
    DataFrame passed as ``spark_or_df``.
    """
    if isinstance(spark_or_df, DataFrame):
        src = spark_or_df
    else:
        src = spark_or_df.range(1)
    s = F.to_date(F.lit(start)) if not isinstance(start, Column) else start
    e = F.to_date(F.lit(end)) if not isinstance(end, Column) else end
    return src.select(F.explode(F.sequence(s, e, F.expr("interval 1 day"))).alias(name))


def densify_daily(df: DataFrame, value_cols: Sequence[str], date_col: str = "date",
                  extra_dates: DataFrame | None = None) -> DataFrame:
    """WN4: resample to daily — one row per day from first to last date,
    first (smallest) value per day, gap days get NULL.

    ``extra_dates`` (a frame with a ``date`` column) widens the range, e.g. to
    every date the facts use.
    """
    per_day = df.groupBy(date_col).agg(*[F.min(c).alias(c) for c in value_cols])
    dates = df.select(date_col)
    if extra_dates is not None:
        dates = dates.unionByName(extra_dates.select(F.col("date").alias(date_col)))
    bounds = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    spine = date_spine(bounds, F.col("lo"), F.col("hi"), date_col)
    return spine.join(per_day, date_col, "left")


def rolling_mean(df: DataFrame, col: str, n: int, keys: Sequence[str] | None = None,
                 order: str | Sequence[str] = "date", out: str | None = None, partitions: int | None = None, block: int = 1 << 20) -> DataFrame:
    """WN6: mean of the last ``n`` rows including the current one; NULL until
    ``n`` rows are available (pandas ``rolling(n).mean()``).

    Without ``keys`` the whole frame is one series: its rows are numbered over
    range partitions and cut into blocks of ``block`` rows, and each block gets
    the last n - 1 rows of the one before as well."""
    out = out or f"{col}_ma{n}"
    if keys:
        w = _w(keys, order).rowsBetween(-(n - 1), 0)
        return df.withColumn(out, F.when(F.count(F.lit(1)).over(w) >= n, F.avg(col).over(w)))
    block = max(block, n)
    rows = number_rows(df, [order] if isinstance(order, str) else order, "__g", partitions).withColumn("__b", F.floor((F.col("__g") - 1) / block))
    to_next = (F.col("__g") - 1) % block >= block - (n - 1)
    both = rows.withColumn("__to", F.explode(F.when(to_next, F.array("__b", F.col("__b") + 1)).otherwise(F.array("__b"))))
    w = Window.partitionBy("__to").orderBy("__g").rowsBetween(-(n - 1), 0)
    mean = F.when(F.col("__g") >= n, F.avg(col).over(w))
    return both.withColumn(out, mean).where(F.col("__to") == F.col("__b")).select(*df.columns, out)


def row_rank(df: DataFrame, order: Sequence, keys: Sequence[str] | None = None,
             out: str = "rank", partitions: int | None = None) -> DataFrame:
    """WN7: 1-based rank by an explicit, total ordering: Columns inside
    ``keys``, or without keys names and (name, ascending) pairs, ranked over
    range partitions (``keys.global_rank`` also has rank and dense_rank)."""
    if not keys:
        return global_rank(df, order, row_number=out, partitions=partitions)
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def target_lags(df: DataFrame, col: str = "sales", lags: Sequence[int] = (1, 7, 14, 28),
                keys: Sequence[str] = ("store_nbr", "family"), order: str = "date") -> DataFrame:
    """WN14: target lags as extra columns ``{col}_lag{k}``."""
    w = _w(list(keys), order)
    return df.withColumns({f"{col}_lag{k}": F.lag(col, k).over(w) for k in lags})


def target_rolling(df: DataFrame, col: str = "sales", windows: Sequence[int] = (7, 28),
                   keys: Sequence[str] = ("store_nbr", "family"), order: str = "date") -> DataFrame:
    """WN15: rolling mean / sample std over the ``w`` rows *before* the current
    one (the current target is excluded, so no leakage)."""
    base = _w(list(keys), order)
    cols = {}
    for w in windows:
        frame = base.rowsBetween(-w, -1)
        cols[f"{col}_rmean{w}"] = F.avg(col).over(frame)
        cols[f"{col}_rstd{w}"] = F.stddev_samp(col).over(frame)
    return df.withColumns(cols)
