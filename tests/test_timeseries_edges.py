import datetime as dt

from pyspark.sql import functions as F

from salescast.operators import joins
from salescast.operators import timeseries as ts
from salescast.operators.keys import dense_keys


def day(n):
    return dt.date(2017, 3, 1) + dt.timedelta(days=n)


def test_fill_series_all_null_stays_null(spark):
    df = spark.createDataFrame([(day(i), None) for i in range(4)], "date date, v double")
    assert [r.v for r in ts.fill_series(df, "v").collect()] == [None] * 4


def test_fill_series_per_key_does_not_leak(spark):
    rows = [("a", day(0), 1.0), ("a", day(1), None), ("b", day(0), None), ("b", day(1), 7.0)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    got = {(r.k, r.date): r.v for r in ts.fill_series(df, "v", ["k"]).collect()}
    assert got == {("a", day(0)): 1.0, ("a", day(1)): 1.0, ("b", day(0)): 7.0, ("b", day(1)): 7.0}


def test_rolling_mean_shorter_than_window(spark):
    df = spark.createDataFrame([(day(i), float(i)) for i in range(5)], "date date, v double")
    assert all(r.v_ma30 is None for r in ts.rolling_mean(df, "v", 30).collect())
    got = [r.v_ma3 for r in ts.rolling_mean(df, "v", 3).orderBy("date").collect()]
    assert got == [None, None, 1.0, 2.0, 3.0]


def test_densify_inserts_gap_days(spark):
    df = spark.createDataFrame([(day(0), 1.0), (day(3), 2.0), (day(3), 5.0)], "date date, v double")
    got = [(r.date, r.v) for r in ts.densify_daily(df, ["v"]).orderBy("date").collect()]
    assert got == [(day(0), 1.0), (day(1), None), (day(2), None), (day(3), 2.0)]


def test_lag_days_vs_rows_on_a_gap(spark):
    rows = [("a", day(i), float(i)) for i in (0, 1, 3, 4)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    by_rows = {r.date: r.v_lag1 for r in ts.lag_rows(df, "v", 1, ["k"]).collect()}
    by_days = {r.date: r.v_lag1d for r in ts.lag_days(df, "v", 1, ["k"]).collect()}
    assert by_rows[day(3)] == 1.0 and by_days[day(3)] is None


def test_dense_keys_sorted_and_contiguous(spark):
    vals = [f"v{(i * 7919) % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals] * 2, "x string")
    got = sorted((r.k, r.x) for r in dense_keys(df, "x", "k", start=1, partitions=7).collect())
    assert [k for k, _ in got] == list(range(1, 1001))
    assert [x for _, x in got] == sorted(set(vals))


def test_scoring_grid_sizes(spark):
    series = spark.createDataFrame([(1, "A"), (2, "B")], "store_nbr int, family string")
    g = joins.scoring_grid(series, "2017-12-30", 5)
    assert g.count() == 10 and g.agg(F.max("date")).first()[0] == dt.date(2018, 1, 3)
