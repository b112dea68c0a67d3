"""Dense surrogate keys over sorted distinct values, computed distributed.

``dense_keys(df, col, out, start)`` numbers the distinct values of ``col`` in
ascending order (``start``, ``start + 1``, ...) without moving all values to
one task:

1. the distinct values are range-partitioned on ``col`` and written together
   with their partition id (a written table, so the split is fixed even if a
   task is retried);
2. rows per partition are counted — one row per partition — and a prefix sum
   over that small table gives each partition's offset;
3. inside each partition a row number over the sorted values, plus the
   partition's offset, is the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.session import materialize


def dense_keys(df: DataFrame, col: str, out: str, start: int = 1, partitions: int | None = None,
               as_string: bool = False) -> DataFrame:
    spark = df.sparkSession
    value = F.col(col).cast("string") if as_string else F.col(col)
    vals = df.select(value.alias(col)).distinct()
    # without a count, AQE coalesces small ranges (neighbours, so order holds)
    ranged = vals.repartitionByRange(partitions, col) if partitions else vals.repartitionByRange(col)
    ranged = ranged.withColumn("__pid", F.spark_partition_id())
    ranged = materialize(ranged, spark, "keys")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = ranged.withColumn("__r", F.row_number().over(Window.partitionBy("__pid").orderBy(col)))
    # ``offsets`` has one row per range partition: a fixed, small broadcast side
    return (local.join(F.broadcast(offsets), "__pid")
                 .select(col, (F.col("__off") + F.col("__r") + (start - 1)).cast("int").alias(out)))


def _ordering(order) -> list:
    """Sort columns of (name, ascending) pairs or names; NULL is smallest."""
    pairs = [(o, True) if isinstance(o, str) else o for o in order]
    return [F.col(f"`{n}`").asc_nulls_first() if up else F.col(f"`{n}`").desc_nulls_last() for n, up in pairs]


def running(df: DataFrame, order, sums: dict, partitions: int | None = None) -> DataFrame:
    """``df`` with running sums over one ordering of all its rows, without a
    window over them all: for each ``out: column`` of ``sums``, ``out`` is the
    sum of the column over all rows before this one.

    Rows are range-partitioned and written with their partition number, so the
    split holds when a task is repeated; a prefix sum over one row a partition
    gives what lies before each, and a window inside it the rest.  The ordering
    should be total; rows alike in it lie in one partition, in any order."""
    cols = _ordering(order)
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = materialize(ranged.withColumn("__pid", F.spark_partition_id()), df.sparkSession, "ranges")
    totals = ranged.groupBy("__pid").agg(*[F.sum(c).alias(f"__t{i}") for i, c in enumerate(sums.values())])
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = totals.select("__pid", *[F.coalesce(F.sum(f"__t{i}").over(before), F.lit(0)).alias(f"__o{i}") for i in range(len(sums))])
    inside = Window.partitionBy("__pid").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"__s{i}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for i, c in enumerate(sums.values())})
    out = local.join(F.broadcast(offsets), "__pid")  # one row a partition
    return out.select(*df.columns, *[(F.col(f"__o{i}") + F.col(f"__s{i}")).alias(o) for i, o in enumerate(sums)])


def number_rows(df: DataFrame, order, out: str, partitions: int | None = None) -> DataFrame:
    """1-based position of each row in a total ordering of all rows."""
    one = df.withColumn("__one", F.lit(1).cast("long"))
    return running(one, order, {out: "__one"}, partitions).withColumn(out, F.col(out) + 1).drop("__one")


def global_rank(df: DataFrame, order, row_number: str | None = None, rank: str | None = None, dense_rank: str | None = None,
                partitions: int | None = None) -> DataFrame:
    """WN7 over all rows, by any ordering: the named ones of row_number, rank and
    dense_rank as long columns.

    Ranks are running sums over the distinct ordering values and their counts, so
    a value that a third of all rows share is one row there; rows get them back by
    a join that AQE can split.  row_number goes on inside a value by the partition
    that a row was read in and its place there, so no value's rows are gathered;
    among rows alike in the ordering its order is arbitrary, but a permutation."""
    names = [o if isinstance(o, str) else o[0] for o in order]
    rows = materialize(df.withColumn("__src", F.spark_partition_id()), df.sparkSession, "rank-rows")
    each = rows.groupBy(*names, "__src").agg(F.count(F.lit(1)).alias("__n"))
    total = each.groupBy(*names).agg(F.sum("__n").alias("__n")).withColumn("__one", F.lit(1).cast("long"))
    place = running(total, order, {"__rank": "__n", "__dense": "__one"}, partitions)
    place = place.select(*[F.col(f"`{n}`").alias(f"__k{i}") for i, n in enumerate(names)], "__rank", "__dense")
    same = [F.col(f"`{n}`").eqNullSafe(F.col(f"__k{i}")) for i, n in enumerate(names)]
    match = same[0]
    for s in same[1:]:
        match = match & s
    if row_number:
        before = Window.partitionBy(*names).orderBy("__src").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition of the input
        shift = each.withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        shift = shift.select(*[F.col(f"`{n}`").alias(f"__j{i}") for i, n in enumerate(names)], F.col("__src").alias("__from"), "__shift")
        here = F.col("__src") == F.col("__from")
        for i, n in enumerate(names):
            here = here & F.col(f"`{n}`").eqNullSafe(F.col(f"__j{i}"))
        local = rows.withColumn("__r", F.row_number().over(Window.partitionBy(*names, "__src").orderBy(*[F.col(f"`{n}`") for n in names])))
        rows = local.join(shift, here)
    out = rows.join(place, match)
    made = {row_number: F.col("__rank") + F.col("__shift") + F.col("__r") if row_number else None, rank: F.col("__rank") + 1, dense_rank: F.col("__dense") + 1}
    return out.select(*df.columns, *[c.alias(k) for k, c in made.items() if k])


class KeyRegistry:
    """WN8 / SB5: surrogate keys that never move once given.

    A written table of (value, key).  A refresh numbers only values it lacks,
    after the largest key so far, in ascending order, and appends them as a folder
    of its own; a refresh that failed left no success mark and is not read.  One
    writer at a time; NULL gets no key."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _batches(self) -> list[str]:
        from salescast.sources.io import exists
        out = []
        while exists(self.spark, f"{self.path}/refresh={len(out)}/_SUCCESS"):
            out.append(f"{self.path}/refresh={len(out)}")
        return out

    def table(self, kind: str = "string") -> DataFrame:
        """(value, key) of all complete refreshes."""
        done = self._batches()
        return self.spark.read.parquet(*done) if done else self.spark.createDataFrame([], f"value {kind}, key int")

    def refresh(self, df: DataFrame, col: str) -> DataFrame:
        """The table after giving keys to the new values of ``df[col]``."""
        known = self.table(df.schema[col].dataType.simpleString())
        last = known.agg(F.max("key")).first()[0] or 0
        new = df.select(F.col(col).alias("value")).where("value is not null").distinct().join(known, "value", "left_anti")
        dense_keys(new, "value", "key", start=last + 1).write.mode("overwrite").parquet(f"{self.path}/refresh={len(self._batches())}")
        return self.table()
