"""Ranks, fills and rolling means over one ordering of all rows, stable keys and
refreshed tables."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.operators import keys, timeseries as ts
from salescast.operators.star import build_dim_product
from salescast.sources.versioned import YearTable


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(1)
    data = [(i, float(rng.integers(0, 9)) if 40 < i < 900 and i % 50 < 7 else None, int(rng.integers(0, 5)) if i % 3 else 2) for i in range(1000)]
    return data, spark.createDataFrame(data, "t long, v double, tie int").repartition(7).cache()


@pytest.mark.parametrize("partitions", [1, 50, None])
def test_fill_carries_over_partitions(series, partitions):
    data, df = series
    want, last = {}, None
    for t, v, _ in data:
        last = v if v is not None else last
        want[t] = last
    first = next(v for _, v, _ in data if v is not None)
    got = {r.t: r.v for r in ts.fill_series(df, "v", None, "t", partitions).collect()}
    assert got == {t: first if v is None else v for t, v in want.items()}
    nothing = ts.fill_series(df.where("t < 30"), "v", None, "t", partitions).collect()
    assert len(nothing) == 30 and all(r.v is None for r in nothing)


@pytest.mark.parametrize("partitions, block", [(1, 1 << 20), (50, 1 << 20), (50, 31), (3, 100)])
def test_rolling_mean_in_blocks(series, partitions, block):
    data, df = series
    full = df.fillna(0.0, ["v"])
    values = [v or 0.0 for _, v, _ in data]
    got = {r.t: r.v_ma30 for r in ts.rolling_mean(full, "v", 30, None, "t", partitions=partitions, block=block).collect()}
    assert len(got) == 1000 and all(got[t] is None for t in range(29))
    assert all(abs(got[t] - np.mean(values[t - 29: t + 1])) < 1e-9 for t in range(29, 1000))


@pytest.mark.parametrize("partitions", [1, 50, None])
def test_ranks_of_ties(series, partitions):
    data, df = series
    out = keys.global_rank(df, [("tie", False)], "row_number", "rank", "dense_rank", partitions)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("hashpartitioning")[0]
    rows = out.collect()
    values = sorted({x for _, _, x in data}, reverse=True)
    before = {x: sum(y > x for _, _, y in data) for x in values}
    assert sorted(r.row_number for r in rows) == list(range(1, 1001))
    for r in rows:
        assert r["rank"] == before[r.tie] + 1 and r.dense_rank == values.index(r.tie) + 1
        assert before[r.tie] < r.row_number <= before[r.tie] + sum(y == r.tie for _, _, y in data)
    nulls = keys.global_rank(df, [("v", True), "t"], row_number="n", partitions=partitions).orderBy("n").collect()
    assert [(r.v, r.t) for r in nulls] == sorted(((v, t) for t, v, _ in data), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert keys.global_rank(df.limit(0), ["t"], rank="r").count() == 0


def test_registered_keys_never_move(spark, tmpdir_path):
    frame = lambda *names: spark.createDataFrame([(n,) for n in names], "family string")
    registry = keys.KeyRegistry(spark, f"{tmpdir_path}/keys")
    one = build_dim_product(frame("M", "B", "B", None), registry=registry)
    assert sorted((r.product_key, r.family) for r in one.collect()) == [(1, "B"), (2, "M")]
    two = build_dim_product(frame("A", "M", "C"), registry=registry)
    assert sorted((r.product_key, r.family) for r in two.collect()) == [(1, "B"), (2, "M"), (3, "A"), (4, "C")]
    assert build_dim_product(frame("B"), registry=registry).count() == 4  # nothing new
    # a refresh that broke before its success mark is not read, and is written again
    spark.createDataFrame([("X", 99)], "value string, key int").write.parquet(f"{tmpdir_path}/keys/refresh=3")
    fs = spark._jvm.org.apache.hadoop.fs.Path(f"{tmpdir_path}/keys/refresh=3/_SUCCESS")
    fs.getFileSystem(spark._jsc.hadoopConfiguration()).delete(fs, False)
    assert sorted((r.key, r.value) for r in registry.refresh(frame("D"), "family").collect())[-1] == (5, "D")


def test_a_load_touches_its_years_and_a_failed_one_nothing(spark, tmpdir_path, monkeypatch):
    rows = [(dt.date(2015, 12, 30) + dt.timedelta(days=i), float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "date date, sales double")
    table = YearTable(spark, f"{tmpdir_path}/fact")
    assert table.read() is None and table.load(df) == [2015, 2016, 2017]
    before = table.years()
    day = spark.createDataFrame([(dt.date(2016, 3, 1), -1.0), (dt.date(2016, 3, 1), -2.0)], "date date, sales double")
    assert table.load(day) == [2016]
    after = table.years()
    assert {y for y in after if after[y] != before[y]} == {2016}
    want = sorted([r for r in rows if r[0] != dt.date(2016, 3, 1)] + [(dt.date(2016, 3, 1), -1.0), (dt.date(2016, 3, 1), -2.0)])
    read = lambda: sorted((r.date, r.sales) for r in table.read().collect())
    assert read() == want
    files = table.read().where("year = 2015").inputFiles()
    assert files and table.read().where(F.col("year") == 2015).count() == 2
    monkeypatch.setattr(YearTable, "_switch", lambda self, years: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.load(spark.createDataFrame([(dt.date(2017, 1, 1), 0.0)], "date date, sales double"))
    assert read() == want
