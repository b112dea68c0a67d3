"""Queries for 2.9 (ML data operators) and FC3 (model scoring).

SQL-expressible operators (encoding, split, metrics, leaderboard of
statistical baselines, folds, naive, ETS, histogram) have oracles; MLlib
model fits are checked by rows only.  They run the configurations of
``ml.train.CONFIGS``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from salescast.operators import clean, forecast as fc
from salescast.operators.ml import backtest as bt
from salescast.operators.ml import encode, evaluate as ev, split, train as tr, trees as tt
from salescast.plans.catalog import query
from salescast.plans.oracle_base import category_sql
from salescast.session import materialize

KEYS = ["store_nbr", "family"]

# matched holdout rows: actual sales vs the rule forecast at noise 0
BT_ROWS = """
bt_rows AS (
  SELECT f.date, f.store_nbr, f.family, f.sales AS actual, p.predicted_sales AS predicted,
         """ + category_sql("f.family") + """ AS category
  FROM features f JOIN bt_pred p ON f.date = p.date AND f.store_nbr = p.store_nbr AND f.family = p.family)"""


def _bt_rows(ctx):
    cut = split.cutoff(ctx.features)
    preds = fc.demo_forecast(ctx.features.where(F.col("date") > cut), noise=0.0)
    return preds.select("date", "store_nbr", "family", F.col("sales").alias("actual"), F.col("predicted_sales").alias("predicted"),
                        clean.category_col("family", ctx.family_to_category).alias("category"))


def _metric_sql(y="actual", p="predicted"):
    return f"""round(sqrt(SUM(({y} - {p}) * ({y} - {p})) / COUNT(*)), 6) AS rmse,
       round(AVG(abs({y} - {p})), 6) AS mae,
       round(1 - SUM(({y} - {p}) * ({y} - {p})) / NULLIF(var_pop({y}) * COUNT(*), 0), 6) AS r2,
       round(sqrt(SUM(({y} - {p}) * ({y} - {p})) / COUNT(*)) / NULLIF(MAX({y}) - MIN({y}), 0), 6) AS normalized_rmse,
       round(AVG(CASE WHEN {y} > 0 THEN abs({y} - {p}) / abs({y}) END) * 100, 6) AS mape,
       round(SUM(abs({y} - {p})) / NULLIF(SUM(abs({y})), 0) * 100, 6) AS wape,
       COUNT(*) AS n"""


@query("ml1_label_codes", """
SELECT 'family' AS "column", value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT family AS value FROM features)
UNION ALL
SELECT 'city', value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS INTEGER) FROM (SELECT DISTINCT city AS value FROM features)
UNION ALL
SELECT 'state', value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS INTEGER) FROM (SELECT DISTINCT state AS value FROM features)
UNION ALL
SELECT 'type', value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS INTEGER) FROM (SELECT DISTINCT type AS value FROM features)""")
def ml1_label_codes(ctx):
    """ML1: 0-based codes in ascending string order per categorical column."""
    out = None
    for c, codes in encode.fit_encoders(ctx.features).items():
        part = codes.select(F.lit(c).alias("column"), "value", "code")
        out = part if out is None else out.unionByName(part)
    return out


@query("ml1_unseen_to_zero", """
SELECT COALESCE(c.code, 0) AS code, COUNT(*) AS rows
FROM fc_frame f LEFT JOIN (SELECT value, CAST(ROW_NUMBER() OVER (ORDER BY value) - 1 AS INTEGER) AS code
     FROM (SELECT DISTINCT city AS value FROM features WHERE state <> 'AFRICA')) c ON f.city = c.value
GROUP BY 1""")
def ml1_unseen_to_zero(ctx):
    """ML1 at scoring time: codes fitted without the stores of one state;
    their cities are unseen and get code 0."""
    enc = {"city": encode.label_codes(ctx.features.where(F.col("state") != "AFRICA"), "city")}
    frame = encode.encode(fc.scoring_frame(ctx.star, ctx.features), enc)
    return frame.groupBy(F.col("city").alias("code")).agg(F.count(F.lit(1)).alias("rows"))


@query("ml3_time_split", """
SELECT CASE WHEN date <= (SELECT MAX(date) - 90 FROM features) THEN 'train' ELSE 'test' END AS split,
       COUNT(*) AS rows, MIN(date) AS first_date, MAX(date) AS last_date FROM features GROUP BY 1""")
def ml3_time_split(ctx):
    """ML3 / PR17: train ≤ max(date) − 90 days < test."""
    return split.split_summary(ctx.features)


@query("ml8_holdout_metrics", f"SELECT {_metric_sql()} FROM bt_rows", ctes=BT_ROWS)
def ml8_holdout_metrics(ctx):
    """ML8: RMSE, MAE, R², NRMSE, MAPE (actual > 0), WAPE, n on the holdout."""
    rows = _bt_rows(ctx)
    return ev.metrics(rows)


BASELINES_SQL = """
WITH cut AS (SELECT MAX(date) - 90 AS c FROM features),
test AS (SELECT date, store_nbr, family, sales FROM features WHERE date > (SELECT c FROM cut)),
hist AS (SELECT date, store_nbr, family, sales FROM features WHERE date <= (SELECT c FROM cut)),
naive7 AS (
  SELECT t.sales AS actual, h.sales AS predicted FROM test t LEFT JOIN hist h
  ON h.store_nbr = t.store_nbr AND h.family = t.family
  AND h.date = t.date - CAST(7 * ceil(datediff('day', (SELECT c FROM cut), t.date) / 7) AS INTEGER)),
lvl AS (SELECT store_nbr, family, round(list_reduce(list(sales ORDER BY date), lambda acc, x:
               CAST(0.3 AS DOUBLE) * x + CAST(0.7 AS DOUBLE) * acc), 6) AS level FROM hist GROUP BY ALL),
ets AS (SELECT t.sales AS actual, l.level AS predicted FROM test t LEFT JOIN lvl l
        ON t.store_nbr = l.store_nbr AND t.family = l.family),
rule AS (SELECT actual, predicted FROM bt_rows),
allm AS (
  SELECT 'SeasonalNaive7' AS model, """ + _metric_sql() + """ FROM naive7 WHERE actual IS NOT NULL AND predicted IS NOT NULL
  UNION ALL SELECT 'ExpSmoothing', """ + _metric_sql() + """ FROM ets WHERE actual IS NOT NULL AND predicted IS NOT NULL
  UNION ALL SELECT 'RuleForecast', """ + _metric_sql() + """ FROM rule)
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY normalized_rmse ASC NULLS LAST, model) AS INTEGER) AS rank
FROM allm"""


def _baseline_metrics(ctx):
    feats = ctx.features
    cut = split.cutoff(feats)
    hist = feats.where(F.col("date") <= cut).select(*KEYS, "date", "sales")
    test = feats.where(F.col("date") > cut).select(*KEYS, "date", F.col("sales").alias("actual"))
    naive = bt.seasonal_naive(hist, test, KEYS, 7, origin=cut)
    lvl = bt.ets_level(hist, KEYS, 0.3)
    ets = test.join(lvl, KEYS, "left").withColumnRenamed("level", "predicted")
    rule = _bt_rows(ctx)
    parts = [("SeasonalNaive7", naive), ("ExpSmoothing", ets), ("RuleForecast", rule)]
    out = None
    for name, df in parts:
        m = ev.metrics(df).select(F.lit(name).alias("model"), "*")
        out = m if out is None else out.unionByName(m)
    return out


@query("ml9_baseline_leaderboard", BASELINES_SQL, ctes=BT_ROWS)
def ml9_baseline_leaderboard(ctx):
    """ML9 / ML7c / ML7d: statistical baselines on the 90-day holdout, ranked
    by NRMSE (seasonal naive, exponential smoothing, rule forecast)."""
    return ev.leaderboard(_baseline_metrics(ctx)).drop("is_best")


@query("ml10_best_baseline", "SELECT model, normalized_rmse FROM (" + BASELINES_SQL.replace("WITH cut", "WITH cut", 1)
       + ") WHERE rank = 1", ctes=BT_ROWS)
def ml10_best_baseline(ctx):
    """ML10: the best model of the leaderboard."""
    return ev.best_model(ev.leaderboard(_baseline_metrics(ctx))).select("model", "normalized_rmse")


@query("ml7c_ets_levels", """
SELECT store_nbr, family, round(list_reduce(list(sales ORDER BY date), lambda acc, x:
       CAST(0.3 AS DOUBLE) * x + CAST(0.7 AS DOUBLE) * acc), 6) AS level FROM features GROUP BY ALL""")
def ml7c_ets_levels(ctx):
    """ML7c: exponential smoothing level per series (alpha 0.3)."""
    return bt.ets_level(ctx.features, KEYS, 0.3)


@query("ml7d_seasonal_naive", """
WITH cut AS (SELECT MAX(date) - 90 AS c FROM features)
SELECT t.date, t.store_nbr, t.family, t.sales, h.sales AS predicted
FROM (SELECT * FROM features WHERE date > (SELECT c FROM cut)) t
LEFT JOIN (SELECT * FROM features WHERE date <= (SELECT c FROM cut)) h
ON h.store_nbr = t.store_nbr AND h.family = t.family
AND h.date = t.date - CAST(7 * ceil(datediff('day', (SELECT c FROM cut), t.date) / 7) AS INTEGER)""")
def ml7d_seasonal_naive(ctx):
    """ML7d: same weekday of the last observed week before the origin."""
    feats = ctx.features
    cut = split.cutoff(feats)
    hist = feats.where(F.col("date") <= cut).select(*KEYS, "date", "sales")
    test = feats.where(F.col("date") > cut).select("date", *KEYS, "sales")
    return bt.seasonal_naive(hist, test, KEYS, 7, origin=cut).select("date", *KEYS, "sales", "predicted")


@query("ml12_residual_summary", """
SELECT round(AVG(actual - predicted), 6) AS mean_residual, round(stddev_samp(actual - predicted), 6) AS std_residual
FROM bt_rows""", ctes=BT_ROWS)
def ml12_residual_summary(ctx):
    rows = _bt_rows(ctx)
    return ev.residual_summary(rows)


@query("ml13_residual_histogram", """
WITH r AS (SELECT actual - predicted AS x FROM bt_rows),
b AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM r),
c AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * 30) + 1, 30) AS INTEGER) AS bin, COUNT(*) AS n FROM r, b GROUP BY 1),
s AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 31))
SELECT s.bin, round(lo + (s.bin - 1) * ((hi - lo) / 30), 6) AS lower, round(lo + s.bin * ((hi - lo) / 30), 6) AS upper,
       COALESCE(n, 0) AS count
FROM s LEFT JOIN c ON s.bin = c.bin, b""", ctes=BT_ROWS)
def ml13_residual_histogram(ctx):
    """ML13: 30 equal-width residual bins, empty bins kept."""
    rows = _bt_rows(ctx)
    return ev.histogram(ev.residuals(rows), "residual", 30)


@query("ml14_accuracy_by_grain", f"""
SELECT 'daily' AS grain, {_metric_sql()} FROM (SELECT date, SUM(actual) AS actual, SUM(predicted) AS predicted FROM bt_rows GROUP BY date)
UNION ALL
SELECT 'weekly', {_metric_sql()} FROM (SELECT CAST(date_trunc('week', date) AS DATE) + 6 AS w, SUM(actual) AS actual,
       SUM(predicted) AS predicted FROM bt_rows GROUP BY 1)""", ctes=BT_ROWS)
def ml14_accuracy_by_grain(ctx):
    """ML14: holdout accuracy of daily and weekly totals."""
    rows = _bt_rows(ctx)
    return ev.metrics_by_grain(rows, "daily").unionByName(ev.metrics_by_grain(rows, "weekly"))


@query("ml14_accuracy_by_category", f"SELECT category, {_metric_sql()} FROM bt_rows GROUP BY category", ctes=BT_ROWS)
def ml14_accuracy_by_category(ctx):
    rows = _bt_rows(ctx)
    return ev.metrics_by_grain(rows, "category")


@query("ml15_rolling_origin_folds", """
WITH t AS (SELECT date, CAST(floor(datediff('day', date, (SELECT MAX(date) FROM features)) / 90) AS INTEGER) AS m FROM features),
tagged AS (
  SELECT 3 - m AS fold, 'test' AS role, date FROM t WHERE m < 3
  UNION ALL
  SELECT UNNEST(generate_series(greatest(3 - m + 1, 1), 3)) AS fold, 'train' AS role, date FROM t WHERE greatest(3 - m + 1, 1) <= 3)
SELECT CAST(fold AS INTEGER) AS fold, role, COUNT(*) AS rows, MIN(date) AS first_date, MAX(date) AS last_date
FROM tagged GROUP BY fold, role""")
def ml15_rolling_origin_folds(ctx):
    """ML15: 3 folds, horizon 90, expanding training window."""
    return bt.fold_summary(ctx.features, 3, 90)


@query("ml15_backtest_naive", """
WITH t AS (SELECT store_nbr, family, date, sales,
                  CAST(floor(datediff('day', date, (SELECT MAX(date) FROM features)) / 90) AS INTEGER) AS m FROM features),
tst AS (SELECT 3 - m AS fold, * FROM t WHERE m < 3),
trn AS (SELECT UNNEST(generate_series(greatest(3 - m + 1, 1), 3)) AS fold, * FROM t WHERE greatest(3 - m + 1, 1) <= 3),
origin AS (SELECT fold, MAX(date) AS o FROM trn GROUP BY fold),
scored AS (
  SELECT te.fold, te.sales AS actual, tr.sales AS predicted
  FROM tst te JOIN origin o ON te.fold = o.fold
  LEFT JOIN trn tr ON tr.fold = te.fold AND tr.store_nbr = te.store_nbr AND tr.family = te.family
  AND tr.date = te.date - CAST(7 * ceil(datediff('day', o.o, te.date) / 7) AS INTEGER))
SELECT CAST(fold AS INTEGER) AS fold, """ + _metric_sql() + """ FROM scored WHERE predicted IS NOT NULL GROUP BY fold""")
def ml15_backtest_naive(ctx):
    """ML15: rolling-origin backtest of the seasonal-naive model, per fold."""
    return bt.backtest_naive(ctx.features, KEYS, 3, 90, 7)


@query("ml17_deviation_flags", """
WITH r AS (SELECT store_nbr, family, date, actual - predicted AS residual FROM bt_rows),
s AS (SELECT store_nbr, family, stddev_samp(residual) AS sd FROM r GROUP BY ALL)
SELECT COUNT(*) FILTER (WHERE abs(residual) > 2 * sd) AS deviations, COUNT(*) AS rows
FROM r JOIN s USING (store_nbr, family)""", ctes=BT_ROWS)
def ml17_deviation_flags(ctx):
    """ML17: residuals beyond 2 per-series standard deviations."""
    rows = _bt_rows(ctx)
    flagged = ev.deviation_flags(rows, KEYS, 2.0)
    return flagged.agg(F.count_if(F.col("is_deviation")).alias("deviations"), F.count(F.lit(1)).alias("rows"))


# --- MLlib models (rows-only) ---------------------------------------------------

def _prepared(ctx):
    return ctx.model_frames


def _holdout_metrics(ctx, name, trees=False):
    _, test, _ = _prepared(ctx)
    model, secs = ctx.fitted(name)
    found = ev.metrics(tr.evaluated(model, test)).select(F.lit(name).alias("model"), "*", F.lit(round(secs, 3)).alias("training_time"))
    if trees and isinstance(model, tt.Ensemble):
        found = found.withColumns({"rounds": F.lit(model.rounds), "best_round": F.lit(model.best_round), "trees": F.lit(len(model.tables)),
                                   "most_leaves": F.lit(max(model.leaves, default=0))})
    return found


def _curve(ctx, name):
    """Validation error after each round, round 0 being the constant model."""
    model, _ = ctx.fitted(name)
    rows = [(name, k, float(e), k == model.best_round) for k, e in enumerate(model.curve)]
    return ctx.spark.createDataFrame(rows, "model string, round int, validation_rmse double, is_best boolean")


@query("ml4_gbt_holdout")
def ml4_gbt_holdout(ctx):
    """ML2 + ML4 + ML8: boosted trees on the 20 features, holdout metrics,
    rounds taken and kept, and leaves of the largest tree."""
    return _holdout_metrics(ctx, "GBT", trees=True)


@query("ml4_validation_curve")
def ml4_validation_curve(ctx):
    """ML4: the curve that the early stopping went by."""
    return _curve(ctx, "GBT")


@query("ml5_second_booster_holdout")
def ml5_second_booster_holdout(ctx):
    """ML5: the second boosted configuration, holdout metrics."""
    return _holdout_metrics(ctx, "GBT-2", trees=True)


@query("ml5_validation_curve")
def ml5_validation_curve(ctx):
    """ML5: the curve that the early stopping went by."""
    return _curve(ctx, "GBT-2")


@query("ml6_random_forest_holdout")
def ml6_random_forest_holdout(ctx):
    """ML6: 200 bootstrap trees of depth 15, grown in groups."""
    return _holdout_metrics(ctx, "RandomForest", trees=True)


@query("ml7_elastic_net_holdout")
def ml7_elastic_net_holdout(ctx):
    return _holdout_metrics(ctx, "ElasticNet")


@query("ml7b_decision_tree_holdout")
def ml7b_decision_tree_holdout(ctx):
    return _holdout_metrics(ctx, "DecisionTree")


@query("ml11_feature_importance")
def ml11_feature_importance(ctx):
    """ML11: normalised importances of a fitted forest (20 rows)."""
    model, _ = ctx.fitted("RandomForest")
    return tr.importance(ctx.spark, model)


@query("ml16_model_search")
def ml16_model_search(ctx):
    """ML16 / ML9: all configurations on the holdout, ranked by NRMSE.  They are
    fitted side by side, and training_time is the time of a fit among the others."""
    ctx.fit_all(tr.CONFIGS)
    out = None
    for name in tr.CONFIGS:
        m = _holdout_metrics(ctx, name)
        out = m if out is None else out.unionByName(m)
    return ev.leaderboard(out)


def _best(ctx):
    """The model that leads the holdout leaderboard."""
    top = ev.best_model(ml16_model_search(ctx)).first()["model"]  # one row a model
    return ctx.fitted(top)[0]


@query("fc3_model_forecast")
def fc3_model_forecast(ctx):
    """FC3 + FC4 + FC6: score the next 90 days with the leaderboard's best model
    (unseen categories -> 0, NaN -> NULL), clip, round, build the forecast fact."""
    _, _, enc = _prepared(ctx)
    model = _best(ctx)
    frame = fc.scoring_frame(ctx.star, ctx.features, transactions="profile")
    scored = fc.score(model, encode.prepare(frame.withColumnRenamed("family", "__family")
                                            .withColumn("family", F.col("__family")), enc))
    scored = scored.drop("family").withColumnRenamed("__family", "family")
    return fc.fact_forecasts(scored, ctx.star.dim_product, ctx.family_to_category)


@query("sl8_leaderboard_head2", "SELECT model, normalized_rmse, rank FROM (" + BASELINES_SQL + ") WHERE rank <= 2",
       ctes=BT_ROWS)
def sl8_leaderboard_head2(ctx):
    """SL8: the first rows of the leaderboard in rank order."""
    lb = ev.leaderboard(_baseline_metrics(ctx))
    return lb.orderBy("rank").limit(2).select("model", "normalized_rmse", "rank")


@query("st1_stream_scoring")
def st1_stream_scoring(ctx):
    """ST1: the scoring frame lands as request files; a Structured Streaming
    job (file source, stateless, checkpointed file sink, available-now
    trigger) scores them with the leaderboard's best model.  Returns the
    streamed output."""
    import uuid
    from salescast.session import shared_folder
    from salescast.streaming import scoring
    spark = ctx.spark
    _, _, enc = _prepared(ctx)
    model = _best(ctx)
    run = f"{shared_folder(spark).rstrip('/')}/salescast-stream/{uuid.uuid4().hex}"
    frame = fc.scoring_frame(ctx.star, ctx.features, transactions="profile")
    frame.select(*[f.name for f in scoring.REQUEST_SCHEMA.fields]).write.parquet(f"{run}/requests")
    q = scoring.start(scoring.score_stream(scoring.request_stream(spark, f"{run}/requests"), model, enc),
                      f"{run}/scored", f"{run}/checkpoint", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{run}/scored")


@query("ml16_rolling_origin_search")
def ml16_rolling_origin_search(ctx):
    """ML15 + ML16: a race of all configurations over 3 rolling-origin folds
    (horizon 90) — the cloud model search re-aimed as Spark jobs.  One row for
    each fit made; models are dropped by a paired test only."""
    import uuid
    from salescast.session import shared_folder

    def prep(train_raw, test_raw):
        enc = encode.fit_encoders(train_raw)
        return tuple(materialize(encode.prepare(x, enc), ctx.spark, "fold") for x in (train_raw, test_raw))
    folder = f"{shared_folder(ctx.spark).rstrip('/')}/salescast-race/{uuid.uuid4().hex}"
    return bt.race(ctx.features, tr.CONFIGS, prep, folder, folds=3, horizon=90, parallelism=len(tr.CONFIGS))


@query("ml14_model_accuracy_by_grain")
def ml14_model_accuracy_by_grain(ctx):
    """ML14 for a fitted model: holdout accuracy of daily and weekly totals
    (the grain of the published daily / weekly MAPE and R²)."""
    _, test, _ = _prepared(ctx)
    model, _ = ctx.fitted("GBT")
    scored = tr.evaluated(model, test, keep=["date"])
    return ev.metrics_by_grain(scored, "daily").unionByName(ev.metrics_by_grain(scored, "weekly"))


@query("st1_request_stream", """
SELECT 'scored' AS sink, '' AS reason, COUNT(*) AS requests FROM fc_frame WHERE day(date) NOT IN (13, 20)
UNION ALL SELECT 'dead', 'no family', COUNT(*) FROM fc_frame WHERE day(date) = 13
UNION ALL SELECT 'dead', 'not JSON', COUNT(*) FROM fc_frame WHERE day(date) = 20""")
def st1_request_stream(ctx):
    """ST1: requests as JSON lines, those of the first of a month sent twice, of
    the 13th without a family and of the 20th cut short; answers and dead letters
    by reason."""
    import uuid
    from salescast.session import shared_folder
    from salescast.streaming import scoring
    spark = ctx.spark
    _, _, enc = _prepared(ctx)
    run = f"{shared_folder(spark).rstrip('/')}/salescast-requests/{uuid.uuid4().hex}"
    frame = fc.scoring_frame(ctx.star, ctx.features, transactions="profile").select(*[f.name for f in scoring.REQUEST_SCHEMA.fields])
    day, name = F.dayofmonth("date"), F.concat_ws("/", "date", "store_nbr", "family")
    sent = frame.withColumn("request_id", name).withColumn("family", F.when(day != 13, F.col("family")))
    line = F.to_json(F.struct("request_id", *frame.columns))
    cut = F.when(day == 20, F.expr("substring(l, 1, length(l) - 1)")).otherwise(F.col("l"))
    lines = sent.withColumn("l", line).select(cut.alias("value"), day.alias("day"))
    lines.select("value").unionByName(lines.where("day = 1").select("value")).write.text(f"{run}/requests")
    scoring.serve(spark, f"{run}/requests", f"{run}/scored", f"{run}/dead", f"{run}/checkpoint", ctx.fitted("DecisionTree")[0], enc,
                  available_now=True).awaitTermination()
    scored = spark.read.parquet(f"{run}/scored").select(F.lit("scored").alias("sink"), F.lit("").alias("reason"))
    dead = spark.read.parquet(f"{run}/dead").select(F.lit("dead").alias("sink"), "reason")
    return scored.unionByName(dead).groupBy("sink", "reason").agg(F.count(F.lit(1)).alias("requests"))
