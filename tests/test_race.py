"""The racing search, and mergeable smoothing."""

import datetime as dt
import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.operators.ml import backtest as bt, train as tr


def day(n):
    return dt.date(2016, 1, 1) + dt.timedelta(days=int(n))


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(5)
    rows = [(day(i), float(i % 7), float(k), float((i % 7 > 3) * 20 * (k > 2) + k + rng.standard_normal())) for i in range(500) for k in range(5)]
    return spark.createDataFrame(rows, "date date, a double, b double, sales double").cache()


@pytest.fixture()
def two_columns(monkeypatch):
    fitted, real = [], tr.fit

    def fit(train, config, label="sales"):
        fitted.append(config)
        return real(train, config, label, cols=["a", "b"])
    monkeypatch.setattr(tr, "fit", fit)
    return fitted


CANDIDATES = {
    "boost": dict(kind="boost", rounds=40, patience=5, step=0.3, depth=4, min_rows=5, validation_days=60),
    "tree": dict(kind="dt", maxDepth=5),
    "line": dict(kind="lr", regParam=0.1),
    "same line": dict(kind="lr", regParam=0.1),
}


def test_race_drops_by_the_paired_test_and_resumes(history, tmpdir_path, two_columns):
    go = lambda: bt.race(history, CANDIDATES, lambda a, b: (a, b), f"{tmpdir_path}/race", parallelism=2)
    out = {(r.model, r.rung): r for r in go().collect()}
    assert {m for m, _ in out} == set(CANDIDATES) and len(out) == len(two_columns)
    assert all((m, 0) in out for m in CANDIDATES)  # all start
    for m in ("line", "same line"):
        assert out[(m, 0)].dropped_at == 0 and (m, 1) not in out
    best = next(r for r in out.values() if r["rank"] == 1)
    assert best.dropped_at is None and (best.model, 3) in out and best.r2 > 0.9
    made = len(two_columns)
    again = {(r.model, r.rung): r for r in go().collect()}
    assert again == out and len(two_columns) == made  # nothing is fitted again


def test_race_that_broke_makes_only_what_is_missing(history, tmpdir_path, two_columns, monkeypatch):
    real = bt.weekly_errors
    calls = []

    def lost(scored):
        calls.append(1)
        if len(calls) == 6:
            raise OSError("lost")
        return real(scored)
    monkeypatch.setattr(bt, "weekly_errors", lost)
    go = lambda: bt.race(history, CANDIDATES, lambda a, b: (a, b), f"{tmpdir_path}/race")
    with pytest.raises(OSError):
        go()
    before = len(two_columns)
    out = go().collect()
    assert len(two_columns) - before == len(out) - 5


def test_free_threads_begin_later_folds_that_count_only_for_models_that_get_there(history, tmpdir_path, monkeypatch):
    last, real, tested, began, made = history.agg(F.max("date")).first()[0], tr.fit, bt.paired, threading.Event(), []
    candidates = {n: dict(kind="dt", maxDepth=4, minInstancesPerNode=k) for n, k in (("a", 1), ("b", 2))}

    def fit(train, config, label="sales"):
        fold = 4 - (last - train.agg(F.max("date")).first()[0]).days // 90
        made.append((config["minInstancesPerNode"], fold))
        if fold == 2:
            began.set()
        elif fold == 1 and made.count((2, 1)) == 2 and config["minInstancesPerNode"] == 2:
            assert began.wait(60)  # a later fold has begun while this rung is not over
        return real(train, config, label, cols=["a", "b"])

    def drop(fits):  # at rung 1
        rung = fits.agg(F.max("rung")).first()[0]
        return tested(fits).withColumn("worse", (F.col("model") == "b") & F.lit(rung == 1))
    monkeypatch.setattr(tr, "fit", fit)
    monkeypatch.setattr(bt, "paired", drop)
    go = lambda k: [r.asDict() for r in bt.race(history, candidates, lambda a, b: (a, b), f"{tmpdir_path}/race-{k}", parallelism=k)
                    .drop("seconds").orderBy("model", "rung").collect()]
    ahead = go(6)
    assert [(r["model"], r["rung"], r["dropped_at"]) for r in ahead] == [("a", k, None) for k in range(4)] + [("b", 0, 1), ("b", 1, 1)]
    assert (2, 2) in made  # begun, and not counted
    made.clear()
    assert go(1) == ahead and len(made) == len(ahead)


def test_a_frame_is_prepared_and_binned_once_for_all_fits(history, tmpdir_path, two_columns, monkeypatch):
    frames, binned, real = [], [], tr.trees.edges
    monkeypatch.setattr(tr.trees, "edges", lambda *a: binned.append(1) or real(*a))
    candidates = {"boost": CANDIDATES["boost"] | {"rounds": 12}, "other": CANDIDATES["boost"] | {"rounds": 12, "step": 0.2},
                  "forest": dict(kind="forest", trees=12, depth=4, bootstrap=True)}
    out = bt.race(history, candidates, lambda a, b: frames.append(1) or (a, b), f"{tmpdir_path}/race", rungs=((1, 0.5), (1, 1.0)), parallelism=3)
    assert {r.model for r in out.collect()} == set(candidates) and len(frames) == 1 and len(binned) == 1


def test_paired_test_against_numpy(spark):
    rng = np.random.default_rng(2)
    a, b, c = rng.random(20) + 1, rng.random(20) + 1.9, rng.random(20) + 1.1
    rows = [(m, 1, 1.0, 0, day(7 * k), 10, float(10 * v[k])) for m, v in (("a", a), ("b", b), ("c", c)) for k in range(20)]
    rows += [("gone", 1, 0.5, -1, day(0), 10, 1.0)]  # not in the last rung
    fits = spark.createDataFrame(rows, "model string, fold int, budget double, rung int, week date, n long, sse double")
    got = {r.model: r for r in bt.paired(fits).collect()}
    assert set(got) == {"a", "b", "c"} and all(r.leader == "a" and r.units == 20 for r in got.values())
    for m, v in (("b", b), ("c", c)):
        d = v - a
        se = d.std(ddof=1) / math.sqrt(20)
        assert abs(got[m].mean_diff - d.mean()) < 1e-9 and abs(got[m].se_diff - se) < 1e-9 and got[m].worse == (d.mean() > 3 * se)
    assert got["b"].worse and not got["a"].worse
    few = {r.model: r for r in bt.paired(fits.where(F.col("week") < F.lit(day(49)))).collect()}
    assert not few["b"].worse  # seven weeks decide nothing


@pytest.mark.parametrize("block_days", [1, 7, 64, 100_000])
def test_smoothing_merges_blocks_in_order(spark, block_days):
    rng = np.random.default_rng(7)
    rows = [(s, day(i * (s + 1)), float(rng.random() * 9)) for s in range(3) for i in range(90)]
    rows += [(3, day(5), 4.0), (4, day(1), 2.0), (4, day(1), 1.0), (4, day(1), 1.0), (4, day(3), None), (5, day(0), None)]  # repeated days, no values
    df = spark.createDataFrame(rows, "s int, date date, sales double").repartition(5)
    want = {}
    for s in range(5):
        level = None
        for _, y in sorted((d, y) for k, d, y in rows if k == s and y is not None):
            level = y if level is None else 0.3 * y + 0.7 * level
        want[s] = round(level, 6)
    got = {r.s: r.level for r in bt.ets_level(df, ["s"], 0.3, block_days=block_days).collect()}
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1.1e-6 for s in want)
