"""ML7c, ML7d, ML15, ML16: statistical baselines and rolling-origin backtests.

Fold assignment is a column expression over the date (no join with a fold
table): with ``m = floor((max_date - date) / horizon)`` a row is in the test
window of fold ``folds - m`` and in the training set of folds
``folds - m + 1 .. folds`` (an expanding window), so each row is replicated
at most ``folds`` times.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.operators.ml import evaluate


def _age_bucket(df: DataFrame, horizon: int):
    mx = df.agg(F.max("date")).scalar()
    return F.floor(F.datediff(mx, F.col("date")) / horizon).cast("int"), mx


def rolling_origin(df: DataFrame, folds: int = 3, horizon: int = 90) -> DataFrame:
    """ML15: every row tagged with (fold, role) for each fold it takes part in."""
    m, _ = _age_bucket(df, horizon)
    test_fold = F.when(m < folds, F.lit(folds) - m)
    first_train = F.greatest(F.lit(folds) - m + 1, F.lit(1))
    train_folds = F.when(first_train <= folds, F.sequence(first_train, F.lit(folds)))
    tagged = df.withColumn("__test", test_fold).withColumn("__train", train_folds)
    test = tagged.where(F.col("__test").isNotNull()).withColumn("fold", F.col("__test")).withColumn("role", F.lit("test"))
    train = (tagged.where(F.col("__train").isNotNull())
                   .withColumn("fold", F.explode("__train")).withColumn("role", F.lit("train")))
    return test.unionByName(train).drop("__test", "__train")


def fold_frames(df: DataFrame, fold: int, folds: int = 3, horizon: int = 90) -> tuple[DataFrame, DataFrame]:
    """(train, test) of one fold, by predicates on the date alone."""
    mx = df.agg(F.max("date")).scalar()
    origin, end = F.date_sub(mx, horizon * (folds - fold + 1)), F.date_sub(mx, horizon * (folds - fold))
    return df.where(F.col("date") <= origin), df.where((F.col("date") > origin) & (F.col("date") <= end))


def fold_summary(df: DataFrame, folds: int = 3, horizon: int = 90) -> DataFrame:
    """Per fold and role: rows and date range; the origin is the last train date."""
    t = rolling_origin(df, folds, horizon)
    return t.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("rows"),
                                         F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def seasonal_naive(history: DataFrame, target: DataFrame, keys: Sequence[str], period: int = 7,
                   origin=None, y: str = "sales", out: str = "predicted") -> DataFrame:
    """ML7d: each target date takes the value of the latest date with the same
    phase at or before ``origin`` (a Column / scalar; default: the day before
    the first target date): ``source = date - period * ceil((date - origin) / period)``.
    An equi-join on (keys, source date), of the last ``period`` days up to the
    origin: no source date lies before them."""
    if origin is None:
        origin = F.date_sub(target.agg(F.min("date")).scalar(), 1)
    steps = F.ceil(F.datediff(F.col("date"), origin) / period).cast("int")
    tgt = target.withColumn("__src", F.date_sub(F.col("date"), steps * period))
    recent = history.where((F.col("date") > F.date_sub(origin, period)) & (F.col("date") <= origin))
    hist = recent.select(*keys, F.col("date").alias("__src"), F.col(y).alias(out))
    return tgt.join(hist, [*keys, "__src"], "left").drop("__src")


def backtest_naive(df: DataFrame, keys: Sequence[str], folds: int = 3, horizon: int = 90,
                   period: int = 7, y: str = "sales") -> DataFrame:
    """Seasonal-naive rolling-origin backtest: metrics per fold (SQL-exact)."""
    parts = None
    for k in range(1, folds + 1):
        train, test = fold_frames(df.select(*keys, "date", y), k, folds, horizon)
        origin = train.agg(F.max("date")).scalar()
        one = seasonal_naive(train, test, keys, period, origin, y).withColumn("fold", F.lit(k))
        parts = one if parts is None else parts.unionByName(one)
    scored = parts.withColumnRenamed(y, "actual")
    return evaluate.metrics(scored, "actual", "predicted", ["fold"])


def ets_level(df: DataFrame, keys: Sequence[str], alpha: float = 0.3, y: str = "sales",
              out: str = "level", block_days: int = 64) -> DataFrame:
    """ML7c: simple exponential smoothing per series; the final level is the
    flat forecast.

    Smoothing a run of values is linear in the level before it: a run is the
    state (n, s), its length and sum of alpha * beta^(n - i) * y_i, and the level
    after it is beta^n * level + s.  Two runs in a row merge to (n + m, beta^m *
    s + t).  Each block of days of a series becomes such a state by an aggregate
    over rows numbered inside the block, and a series' states are merged by a sum
    over its blocks, each weighted by beta to the values behind it; no list of a
    series is held, and windows see one block, or one row a block.  Values of one
    day in a series are taken in ascending order, NULLs are no values; the first
    value is the first level."""
    beta = 1.0 - alpha
    key, keys = [F.col(k) for k in keys], list(keys)
    rows = df.where(F.col(y).isNotNull()).select(*key, F.floor(F.unix_date("date") / block_days).alias("__b"), "date", F.col(y).cast("double").alias("__y"))
    inside = Window.partitionBy(*keys, "__b")
    ranked = rows.select(*keys, "__b", "__y", F.row_number().over(inside.orderBy("date", "__y")).alias("__i"), F.count("*").over(inside).alias("__n"))
    power = F.pow(F.lit(beta), F.col("__n") - F.col("__i"))
    state = ranked.groupBy(*keys, "__b").agg(F.max("__n").alias("__n"), F.sum(alpha * power * F.col("__y")).alias("__s"),
                                             F.max(F.when(F.col("__i") == 1, F.col("__y"))).alias("__first"))
    after = Window.partitionBy(*keys).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    placed = state.withColumn("__after", F.coalesce(F.sum("__n").over(after), F.lit(0)))
    # the first value is the level before itself: beta^(all values) more of it
    level = F.sum(F.pow(F.lit(beta), F.col("__after")) * F.col("__s")) + F.pow(F.lit(beta), F.sum("__n")) * F.min_by("__first", "__b")
    return placed.groupBy(*keys).agg(F.round(level, 6).alias(out))


def search(train: DataFrame, test: DataFrame, candidates: dict, label: str = "sales",
           parallelism: int = 1) -> DataFrame:
    """ML16: fit each candidate config on ``train``, score ``test``, rank.

    Candidates are fitted from up to ``parallelism`` driver threads at once
    (each fit is a distributed job; concurrent jobs share the cluster, like
    MLlib's tuning ``parallelism``); every metric is a distributed
    aggregation.  Returns the leaderboard (one row per candidate) with the
    fit time."""
    from concurrent.futures import ThreadPoolExecutor

    from salescast.operators.ml import train as tr

    def one(item):
        name, cfg = item
        model, secs = tr.fit(train, cfg, label)
        scored = tr.evaluated(model, test, label)
        return evaluate.metrics(scored).select(F.lit(name).alias("model"), "*",
                                               F.lit(round(secs, 3)).alias("training_time"))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(one, candidates.items()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return evaluate.leaderboard(out)


#: Paired units and standard errors of the race's test: with 8 units, three
#: standard errors are a one-sided Student test at 1 % (t(7) = 2.998).
UNITS, ERRORS = 8, 3.0
#: (fold, share of the rounds or trees) of the race, one after the other.
RUNGS = ((1, 0.05), (1, 1.0), (2, 1.0), (3, 1.0))


def scaled(config: dict, share: float) -> dict:
    """A configuration with a share of its rounds, trees or iterations."""
    return {k: max(10, round(v * share)) if k in ("rounds", "trees", "maxIter") else v for k, v in config.items()}


def weekly_errors(scored: DataFrame) -> DataFrame:
    """Sums by week of (date, actual, predicted) rows, from which all metrics follow."""
    from salescast.functions import calendar as cal
    y, e = F.col("actual"), F.col("actual") - F.col("predicted")
    return (scored.dropna(subset=["actual", "predicted"]).groupBy(cal.week_ending("date").alias("week"))
            .agg(F.count("*").alias("n"), F.sum(e * e).alias("sse"), F.sum(F.abs(e)).alias("sae"), F.sum(y).alias("sy"),
                 F.sum(y * y).alias("syy"), F.min(y).alias("lo"), F.max(y).alias("hi")))


def paired(fits: DataFrame) -> DataFrame:
    """Each model against the leader, over the weeks that both were scored on at
    the same budget: (model, leader, units, mean_diff, se_diff, worse).

    The leader has the least mean squared error over all of these; ``worse`` says
    that a model's weekly error is above the leader's by more than ``ERRORS``
    standard errors of the paired differences, over at least ``UNITS`` weeks."""
    last = fits.where(F.col("rung") == fits.agg(F.max("rung")).scalar()).select("model").distinct()
    full = fits.join(last, "model", "left_semi").withColumn("mse", F.col("sse") / F.col("n"))
    total = full.groupBy("model").agg((F.sum("sse") / F.sum("n")).alias("mse"))
    leader = total.agg(F.min(F.struct("mse", "model")).alias("m")).select("m.model")
    first = full.join(leader, "model", "left_semi").select("fold", "budget", "week", F.col("model").alias("leader"), F.col("mse").alias("best"))
    pairs = full.join(first, ["fold", "budget", "week"]).withColumn("d", F.col("mse") - F.col("best"))
    out = pairs.groupBy("model", "leader").agg(F.count("*").alias("units"), F.avg("d").alias("mean_diff"),
                                               (F.stddev_samp("d") / F.sqrt(F.count("*"))).alias("se_diff"))
    worse = (F.col("units") >= UNITS) & (F.col("mean_diff") > ERRORS * F.col("se_diff")) & (F.col("model") != F.col("leader"))
    return out.withColumn("worse", F.coalesce(worse, F.lit(False)))


def race(df: DataFrame, candidates: dict, prepare, folder: str, rungs=RUNGS, folds: int = 3, horizon: int = 90,
         label: str = "sales", parallelism: int = 1) -> DataFrame:
    """ML16 as a race: all candidates start; after each rung (a fold at a share of
    the budget) those that the paired test of ``paired`` finds worse than the
    leader are dropped and fitted no more.

    After the first test, threads that a rung leaves free begin fits of later rungs,
    the leader's first; these count only if their model gets there, and are given
    up when it is dropped.

    Every fit's weekly errors are written to a table of its own below ``folder``;
    a search that is started again reads those that are complete and makes only
    the others, with the same outcome.  Returns one row for each fit made: (model,
    fold, budget, rung, metrics, seconds, dropped_at, rank): dropped_at is the
    rung whose test dropped the model, and rank orders by rungs survived, then by
    the mean NRMSE over full-budget folds (what there is, for models dropped
    before).
    """
    from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

    from salescast.operators.ml import train as tr
    from salescast.sources.io import exists

    spark, root, threads = df.sparkSession, folder.rstrip("/"), max(1, parallelism)
    alive, dropped, begun, ended = list(candidates), {}, {}, set()
    shared = {k: tr.Shared() for k, _ in rungs}

    def frame(k):
        return shared[k].get("frame", lambda: prepare(*fold_frames(df, k, folds, horizon)))

    def one(job):
        name, k, share, rung = job
        path = f"{root}/rung={rung}/model={name}"
        if not exists(spark, f"{path}/_SUCCESS"):
            train_df, test_df = frame(k)
            config = scaled(candidates[name], share) | {"shared": shared[k]}
            if config["kind"] in ("boost", "forest"):  # a larger budget goes on from what the smaller one wrote
                config |= {"folder": f"{root}/runs/fold={k}/{name}", "stop": lambda: name in ended}
            model, secs = tr.fit(train_df, config, label)
            found = weekly_errors(tr.evaluated(model, test_df, label, keep=["date"]))
            found.withColumns({"fold": F.lit(k), "budget": F.lit(float(share)), "seconds": F.lit(round(secs, 3))}).write.mode("overwrite").parquet(path)
        return path

    fits = made = None
    with ThreadPoolExecutor(max_workers=threads) as pool:
        def begin(rung, name):
            if (rung, name) not in begun:
                begun[rung, name] = pool.submit(one, (name, *rungs[rung], rung))

        try:
            for rung in range(len(rungs)):
                for n in alive:
                    begin(rung, n)
                while waiting := [f for n in alive if not (f := begun[rung, n]).done()]:
                    running = {j: f for j, f in begun.items() if not f.done()}
                    for n, r in ((n, r) for n in alive for r in range(rung + 1, len(rungs)) if rung):
                        # a fold's smaller budget comes before its larger one
                        if len(running) < threads and (r, n) not in begun and all((rungs[r][0], n) != (rungs[j][0], m) for j, m in running):
                            begin(r, n)
                            running[r, n] = begun[r, n]
                    wait(running.values(), return_when=FIRST_COMPLETED)
                    for f in waiting:
                        if f.done():
                            f.result()
                for n in alive:
                    begun[rung, n].result()
                got = (F.col("rung") == rung) & F.col("model").isin(alive)  # what was begun ahead of a drop is not read
                made = got if made is None else made | got
                fits = spark.read.option("basePath", root).parquet(*[f"{root}/rung={r}" for r in range(rung + 1)]).where(made)
                tests = {r["model"]: r for r in paired(fits).collect()}  # one row a candidate
                dropped |= {n: rung for n, r in tests.items() if r["worse"]}
                ended |= set(dropped)
                alive = sorted((n for n in alive if n not in dropped), key=lambda n: tests[n]["mean_diff"] if n in tests else math.inf)
        finally:
            ended |= set(candidates)  # nothing is left running
            for f in begun.values():
                f.cancel()
    spread = F.sum("syy") - F.sum("sy") * F.sum("sy") / F.sum("n")
    rmse, width = F.sqrt(F.sum("sse") / F.sum("n")), F.max("hi") - F.min("lo")
    rows = fits.groupBy("model", "fold", "budget", "rung").agg(
        F.round(rmse, 6).alias("rmse"), F.round(F.sum("sae") / F.sum("n"), 6).alias("mae"),
        F.round(1 - F.try_divide(F.sum("sse"), spread), 6).alias("r2"),
        F.round(F.try_divide(rmse, F.when(width > 0, width)), 6).alias("normalized_rmse"),
        F.sum("n").alias("n"), F.max("seconds").alias("seconds"))
    out = spark.createDataFrame([(n, dropped.get(n)) for n in candidates], "model string, dropped_at int")
    mean = rows.groupBy("model").agg(F.avg(F.when(F.col("budget") == 1.0, F.col("normalized_rmse"))).alias("full"),
                                     F.avg("normalized_rmse").alias("any"))
    order = out.join(mean, "model").select("model", "dropped_at", F.row_number().over(Window.orderBy(
        F.coalesce("dropped_at", F.lit(len(rungs))).desc(), F.coalesce("full", "any").asc_nulls_last(), "model")).alias("rank"))
    return rows.join(order, "model").select("model", "fold", "budget", "rung", "rmse", "mae", "r2", "normalized_rmse", "n", "seconds", "dropped_at", "rank")


def cv_search(df: DataFrame, candidates: dict, prepare, folds: int = 3, horizon: int = 90,
              label: str = "sales", parallelism: int = 1) -> DataFrame:
    """ML15 + ML16: every candidate is fitted on each fold's training window
    and scored on its test window (rolling origin); models are ranked by the
    mean NRMSE over folds.  ``prepare(train_df, test_df) -> (train, test)``
    turns raw feature rows into model input (e.g. encoders fitted on the
    fold's training side).  Fits run from up to ``parallelism`` driver
    threads; each is a distributed job."""
    from concurrent.futures import ThreadPoolExecutor

    from salescast.operators.ml import train as tr

    frames = {k: prepare(*fold_frames(df, k, folds, horizon)) for k in range(1, folds + 1)}
    jobs = [(name, cfg, k) for name, cfg in candidates.items() for k in frames]

    def one(job):
        name, cfg, k = job
        tr_df, te_df = frames[k]
        model, secs = tr.fit(tr_df, cfg, label)
        scored = tr.evaluated(model, te_df, label)
        return evaluate.metrics(scored).select(F.lit(name).alias("model"), F.lit(k).alias("fold"), "*",
                                               F.lit(round(secs, 3)).alias("training_time"))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(one, jobs))
    per_fold = parts[0]
    for p in parts[1:]:
        per_fold = per_fold.unionByName(p)
    summary = per_fold.groupBy("model").agg(
        F.round(F.avg("normalized_rmse"), 6).alias("normalized_rmse"), F.round(F.avg("rmse"), 6).alias("rmse"),
        F.round(F.avg("mae"), 6).alias("mae"), F.round(F.avg("r2"), 6).alias("r2"),
        F.count(F.lit(1)).alias("folds"), F.round(F.sum("training_time"), 3).alias("training_time"))
    return evaluate.leaderboard(summary)
