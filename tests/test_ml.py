import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from salescast.operators.ml import backtest as bt
from salescast.operators.ml import encode, evaluate as ev, split


def day(n):
    return dt.date(2017, 1, 1) + dt.timedelta(days=int(n))


def test_synthetic_eval_metrics_match_numpy(spark):
    # trend + two sines, fixed "noise" literals, 90-day tail
    t = np.arange(200)
    y = 100 + 0.5 * t + 10 * np.sin(2 * np.pi * t / 7) + 5 * np.sin(2 * np.pi * t / 30)
    noise = np.array([((i * 37) % 11 - 5) * 0.7 for i in t])
    p = y + noise
    y[5] = 0.0
    rows = [(day(i), float(a), float(b)) for i, a, b in zip(t, y, p)]
    df = spark.createDataFrame(rows, "date date, actual double, predicted double")
    m = ev.metrics(df).first()
    e = y - p
    rmse = math.sqrt(np.mean(e ** 2))
    r2 = 1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2)
    nz = y > 0
    mape = np.mean(np.abs(e[nz]) / np.abs(y[nz])) * 100
    wape = np.sum(np.abs(e)) / np.sum(np.abs(y)) * 100
    assert abs(m.rmse - rmse) < 1e-5 and abs(m.r2 - r2) < 1e-5
    assert abs(m.mae - np.mean(np.abs(e))) < 1e-5 and abs(m.mape - mape) < 1e-5
    assert abs(m.wape - wape) < 1e-5 and m.n == 200
    assert abs(m.normalized_rmse - rmse / (y.max() - y.min())) < 1e-6
    r = ev.residual_summary(df).first()
    assert abs(r.mean_residual - e.mean()) < 1e-5 and abs(r.std_residual - e.std(ddof=1)) < 1e-5
    h = ev.histogram(ev.residuals(df), "residual", 50).orderBy("bin").collect()
    counts, _ = np.histogram(e, bins=50)
    assert [x["count"] for x in h] == counts.tolist()


def test_constant_actuals_nrmse_null(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 4.0)], "actual double, predicted double")
    m = ev.metrics(df).first()
    assert m.normalized_rmse is None and m.r2 is None and m.rmse == 1.0


def test_missing_pairs_dropped(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (2.0, 2.0)], "actual double, predicted double")
    assert ev.metrics(df).first().n == 1


def test_leaderboard_rank_and_best(spark):
    lb = spark.createDataFrame([("b", 0.2), ("a", 0.2), ("c", 0.1), ("d", None)], "model string, normalized_rmse double")
    r = ev.leaderboard(lb).orderBy("rank").collect()
    assert [x.model for x in r] == ["c", "a", "b", "d"] and r[0].is_best
    assert ev.best_model(ev.leaderboard(lb)).first().model == "c"


def test_unseen_category_code_zero(spark):
    train = spark.createDataFrame([("Quito",), ("Ambato",), ("Quito",)], "city string")
    enc = {"city": encode.label_codes(train, "city")}
    score = spark.createDataFrame([("Ambato",), ("Quito",), ("Loja",)], "city string")
    assert [r.city for r in encode.encode(score, enc).orderBy("city").collect()] == [0, 0, 1]


def test_time_split_boundaries(spark):
    df = spark.createDataFrame([(day(i),) for i in range(120)], "date date")
    tr, te = split.time_split(df, 90)
    assert tr.count() == 30 and te.count() == 90
    assert tr.agg(F.max("date")).first()[0] < te.agg(F.min("date")).first()[0]


def test_rolling_origin_folds(spark):
    df = spark.createDataFrame([(day(i),) for i in range(300)], "date date")
    s = {(r.fold, r.role): (r.rows, r.first_date, r.last_date) for r in bt.fold_summary(df, 3, 90).collect()}
    assert s[(3, "test")][0] == 90 and s[(1, "test")][0] == 90
    assert s[(1, "train")][0] == 30 and s[(2, "train")][0] == 120 and s[(3, "train")][0] == 210
    for k in (1, 2, 3):
        assert s[(k, "train")][2] < s[(k, "test")][1]


def test_seasonal_naive_against_brute_force(spark):
    rows = [(1, "A", day(i), float(i * i % 17)) for i in range(40) if i % 9 != 3]
    df = spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double")
    origin = day(29)
    hist = df.where(F.col("date") <= F.lit(origin))
    tgt = df.where(F.col("date") > F.lit(origin)).select("store_nbr", "family", "date")
    got = {r.date: r.predicted for r in bt.seasonal_naive(hist, tgt, ["store_nbr", "family"], 7,
                                                           origin=F.lit(origin)).collect()}
    vals = {r[2]: r[3] for r in rows if r[2] <= origin}
    for t in got:
        k = math.ceil((t - origin).days / 7)
        assert got[t] == vals.get(t - dt.timedelta(days=7 * k))


def test_ets_matches_python_loop(spark):
    ys = [5.0, 7.0, 3.0, 8.0, 10.0]
    df = spark.createDataFrame([(1, "A", day(i), y) for i, y in reversed(list(enumerate(ys)))],
                               "store_nbr int, family string, date date, sales double")
    lvl = ys[0]
    for y in ys[1:]:
        lvl = 0.3 * y + 0.7 * lvl
    assert abs(bt.ets_level(df, ["store_nbr", "family"], 0.3).first().level - round(lvl, 6)) < 1e-9


def test_deviation_flags(spark):
    vals = [0.0] * 20 + [50.0]
    df = spark.createDataFrame([(1, day(i), v, 0.0) for i, v in enumerate(vals)],
                               "s int, date date, actual double, predicted double")
    f = ev.deviation_flags(df, ["s"], 2.0)
    assert f.where("is_deviation").count() == 1


def test_mllib_fit_and_score(spark):
    from salescast.operators.ml import train as tr
    rows = [(float(i % 7), float(i % 3), float(2 * (i % 7) + (i % 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, sales double")
    model, secs = tr.fit(df, dict(kind="dt", maxDepth=6), cols=["a", "b"])
    assert tr.CONFIGS["RandomForest"]["columns"] == 1.0
    pred = tr.predict(model, df).agg(F.max(F.abs(F.col("prediction") - F.col("sales")))).first()[0]
    assert pred < 1e-6 and secs >= 0
    imp = tr.importance(spark, model, ["a", "b"]).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9 and imp[0].feature == "a"


def test_gbt_early_stopping_and_bins_from_the_codes(spark):
    from salescast.operators.ml import train as tr
    rows = [(day(i), float(i % 7), float(i % 3), float(2 * (i % 7) + (i % 3))) for i in range(400)]
    df = spark.createDataFrame(rows, "date date, a double, b double, sales double")
    model, _ = tr.fit(df, dict(kind="gbt", maxIter=50, maxDepth=3, validation_days=30, validationTol=0.01),
                      cols=["a", "b"])
    assert model.stages[-1].getNumTrees <= 50
    codes = spark.createDataFrame([(float(i), 0.0) for i in range(200)], "city double, family double")
    assert tr.bins(codes, ["city", "family"]) == 201 and tr.bins(codes.limit(3), ["city", "family"]) == 64


def test_metrics_use_clipped_unrounded_predictions(spark):
    from salescast.operators.ml import train as tr
    df = spark.createDataFrame([(float(i % 2), float(i % 2) * 0.25 - 0.1) for i in range(40)], "a double, sales double")
    model, _ = tr.fit(df, dict(kind="dt", maxDepth=2), cols=["a"])
    got = {round(r.predicted, 6) for r in tr.evaluated(model, df).collect()}
    assert got == {0.0, 0.15}


def test_fold_frames_equal_the_tagged_rows(spark):
    df = spark.createDataFrame([(day(i),) for i in range(300)], "date date")
    tagged = bt.rolling_origin(df, 3, 90)
    for k in (1, 2, 3):
        for role, got in zip(("train", "test"), bt.fold_frames(df, k, 3, 90)):
            want = tagged.where((F.col("fold") == k) & (F.col("role") == role)).select("date")
            assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_saved_encoders_keep_their_codes(spark, tmpdir_path):
    train = spark.createDataFrame([("Quito",), ("Loja",)], "city string")
    encode.save({"city": encode.label_codes(train, "city")}, tmpdir_path)
    kept = encode.load(spark, tmpdir_path, ["city"])
    more = spark.createDataFrame([("Ambato",), ("Loja",), ("Quito",)], "city string")  # a new first city
    assert [r.city for r in encode.encode(more, kept).orderBy("city").collect()] == [0, 0, 1]


def test_elastic_net_against_coordinate_descent(spark):
    from salescast.operators.ml import train as tr
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 3)) * [1.0, 2.0, 0.5]
    y = 4 + 3 * x[:, 0] - 0.2 * x[:, 1] + rng.standard_normal(400)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, sales double")
    model, _ = tr.fit(df, dict(kind="lr", regParam=0.4, elasticNetParam=0.5, maxIter=1000, tol=1e-10), cols=["a", "b", "c"])
    # 1/(2n) |y - Xw|^2 + r (l |w|_1 + (1 - l)/2 |w|^2) on the scaled label that MLlib fits, without standardising the features
    sd = y.std(ddof=1)
    xc, yc, w, r, l1 = x - x.mean(axis=0), (y - y.mean()) / sd, np.zeros(3), 0.4 / sd, 0.5
    for _ in range(500):
        for k in range(3):
            rest = xc[:, k] @ (yc - xc @ w + xc[:, k] * w[k]) / len(y)
            w[k] = np.sign(rest) * max(abs(rest) - r * l1, 0) / (xc[:, k] @ xc[:, k] / len(y) + r * (1 - l1))
    assert np.allclose(model.stages[-1].coefficients.toArray(), w * sd, atol=1e-3)
    assert abs(model.stages[-1].intercept - (y.mean() - x.mean(axis=0) @ (w * sd))) < 2e-3


def test_decision_tree_against_an_exhaustive_search(spark):
    from salescast.operators.ml import train as tr
    from tests.test_trees import exhaustive
    rng = np.random.default_rng(6)
    x = rng.integers(0, 9, (500, 3)).astype(float)
    y = x[:, 0] * 2 + (x[:, 1] > 4) * x[:, 2] + rng.standard_normal(500) / 10
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, sales double")
    model, _ = tr.fit(df, dict(kind="dt", maxDepth=4, minInstancesPerNode=10), cols=["a", "b", "c"])
    got = np.array([r.prediction for r in model.transform(df).select("a", "b", "c", "sales", "prediction").collect()])
    assert np.allclose(got, exhaustive(x, y, 4, 10), atol=1e-9)


def test_forecast_of_an_ensemble_follows_its_trees(spark):
    from salescast.operators import forecast as fc
    from salescast.operators.ml import trees
    df = spark.createDataFrame([(1.0, 5.0, 3.4), (2.0, 6.0, 8.6), (3.0, 7.0, -2.0)], "a double, b double, sales double")
    tables = [(np.array([0, -1, -1], np.int16), np.array([0, 0, 0], np.uint8), np.array([1, -1, -1], np.int32), np.array([0.0, 3.4, 8.0])),
              (np.array([1, -1, -1], np.int16), np.array([1, 0, 0], np.uint8), np.array([1, -1, -1], np.int32), np.array([0.0, 0.1, -20.0]))]
    model = trees.Ensemble("boost", ["a", "b"], [np.array([1.0, 2.0]), np.array([5.0, 6.0])], tables, 1.0, 2, 2, [], 0.0, np.zeros(2))
    got = [r.predicted_sales for r in fc.score(model, df).orderBy("a").collect()]
    assert got == [4.0, 9.0, 0.0]  # 1 + 3.4 + 0.1 -> 4 (half to even), 1 + 8 + 0.1 -> 9, 1 + 8 - 20 clipped
