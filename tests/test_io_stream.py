import datetime as dt
import os

from pyspark.sql import functions as F

from salescast.operators import forecast as fc
from salescast.operators import star as starmod
from salescast.operators.ml import encode, train as tr
from salescast.plans.context import Context
from salescast.sources import io
from salescast.streaming import scoring
from tests.conftest import SF_SMALL


def test_csv_round_trip_with_schema(spark, tmpdir_path):
    rows = [(1, dt.date(2017, 1, 1), 3, "GROCERY I", 2.5, 0), (2, dt.date(2017, 1, 2), 3, "LIQUOR,WINE,BEER", 1.0, 1)]
    df = spark.createDataFrame(rows, io.RAW_SCHEMAS["train"])
    path = os.path.join(tmpdir_path, "train.csv")
    io.write_csv(df, path)
    back = io.read_csv(spark, path, io.RAW_SCHEMAS["train"]).orderBy("id").collect()
    assert [tuple(r) for r in back] == rows   # the quoted comma survives


def test_write_star_partitions_and_load(spark, tmpdir_path):
    ctx = Context(spark, SF_SMALL)
    star = ctx.forecast_star
    root = os.path.join(tmpdir_path, "star")
    io.write_star(star, root)
    fs = io.read_parquet(spark, f"{root}/fact_sales", ["date_key", "revenue", "year"])
    assert fs.count() == star.fact_sales.count()
    assert any(p.startswith("year=") for p in os.listdir(f"{root}/fact_sales"))
    plan = fs.where(F.col("year") == 1998)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    loaded = io.load_fact(spark.read.parquet(f"{root}/fact_forecasts"), "forecasts")
    assert "date" not in loaded.columns and loaded.select("data_source").distinct().count() == 1


def test_results_json_round_trip(spark, tmpdir_path):
    lb = spark.createDataFrame([("GBT", 0.01, 2.0, 1.0, 10.0, 0.9, 3.0), ("LR", 0.04, 9.0, 5.0, 50.0, 0.3, 1.0)],
                               "model string, normalized_rmse double, rmse double, mae double, mape double, "
                               "r2 double, training_time double")
    res = io.results_frame(lb, "cpu", 1234)
    path = os.path.join(tmpdir_path, "results")
    io.write_results(res, path)
    r = io.read_results(spark, path).first()
    assert r.best_model == "GBT" and r.metrics.model == "GBT" and r.dataset_rows == 1234
    assert [m.model for m in r.all_models] == ["GBT", "LR"]


def test_model_save_load_and_stream_scoring(spark, tmpdir_path):
    ctx = Context(spark, SF_SMALL)
    feats = ctx.features
    enc = encode.fit_encoders(feats)
    model, _ = tr.fit(encode.prepare(feats, enc), dict(kind="dt", maxDepth=5))
    mpath = os.path.join(tmpdir_path, "model")
    io.save_model(model, mpath)
    model2 = io.load_model(mpath)
    # requests: the scoring frame, landing as several files
    frame = fc.scoring_frame(ctx.star, feats, horizon=3)
    req_dir = os.path.join(tmpdir_path, "requests")
    frame.select(*[f.name for f in scoring.REQUEST_SCHEMA.fields]).repartition(3).write.parquet(req_dir)
    out_dir = os.path.join(tmpdir_path, "scored")
    q = scoring.start(scoring.score_stream(scoring.request_stream(spark, req_dir), model2, enc),
                      out_dir, os.path.join(tmpdir_path, "ckpt"), available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(out_dir)
    assert out.count() == frame.count()
    assert out.where(F.col("predicted_sales") < 0).count() == 0
    # batch scoring of the same rows agrees with the stream
    batch = fc.score(model2, encode.prepare(frame.withColumn("__family", F.col("family")), enc))
    assert batch.agg(F.sum("predicted_sales")).first()[0] == out.agg(F.sum("predicted_sales")).first()[0]


def test_checkpointed_features_cut_lineage(spark):
    ctx = Context(spark, SF_SMALL)
    cp = ctx.features.checkpoint(eager=True)
    assert cp.count() == ctx.features.count()
    assert starmod.build_star(cp, ctx.family_to_category).fact_sales.count() == cp.count()


def test_prepare_plan_writes_and_reloads_star(spark, tmpdir_path):
    from salescast.plans.prepare import prepare
    ctx = Context(spark, SF_SMALL)
    star = prepare(spark, ctx.raw.as_dict(), tmpdir_path, ctx.family_to_category, ctx.state_to_region)
    assert star.fact_sales.count() == ctx.star.fact_sales.count()
    assert sorted(star.fact_sales.columns) == sorted(ctx.star.fact_sales.columns + ["year"])
    assert star.fact_forecasts is None
    a = star.fact_sales.agg(F.sum("revenue")).first()[0]
    b = ctx.star.fact_sales.agg(F.sum("revenue")).first()[0]
    assert a == b


def test_register_measure_extension_point(spark):
    from salescast.operators import measures as me
    ctx = Context(spark, SF_SMALL)
    me.register_measure("promo_lines", lambda df: F.sum("onpromotion"))
    out = me.custom(ctx.star, "promo_lines", by=["category"])
    tot = ctx.star.fact_sales.agg(F.sum("onpromotion")).first()[0]
    assert out.agg(F.sum("promo_lines")).first()[0] == tot


def test_export_forecasts_and_null_on_failed_rows(spark, tmpdir_path):
    ctx = Context(spark, SF_SMALL)
    ff = ctx.forecast_star.fact_forecasts
    fc.export_forecasts(ff, tmpdir_path)
    back = spark.read.option("header", True).csv(f"{tmpdir_path}/fact_forecasts.csv")
    assert back.count() == ff.count()
    wk = spark.read.option("header", True).csv(f"{tmpdir_path}/fact_forecasts_weekly.csv")
    assert wk.count() >= 13

    class NaNModel:  # a model whose scoring fails for some rows
        def transform(self, df):
            return df.withColumn("prediction", F.when(F.col("x") > 1, F.lit(float("nan"))).otherwise(F.col("x") * 1.0))

    df = spark.createDataFrame([(1,), (2,)], "x int")
    got = [r.predicted_sales for r in fc.score(NaNModel(), df).orderBy("x").collect()]
    assert got == [1.0, None]


def test_train_and_forecast_plan(spark, tmpdir_path):
    from salescast.plans.train_score import rule_forecast, train_and_forecast
    ctx = Context(spark, SF_SMALL)
    cands = {"DecisionTree": dict(kind="dt", maxDepth=4), "ElasticNet": dict(kind="lr", regParam=1.0,
                                                                             elasticNetParam=0.5, maxIter=20)}
    out = train_and_forecast(spark, ctx.features, ctx.star, tmpdir_path, cands, horizon=5,
                             family_to_category=ctx.family_to_category)
    assert out["best_model"] in cands
    res = io.read_results(spark, f"{tmpdir_path}/training_results").first()
    assert res.best_model == out["best_model"] and len(res.all_models) == 2
    series = ctx.features.select("store_nbr", "family").distinct().count()
    assert out["fact_forecasts"].count() == series * 5
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/leaderboard").count() == 2
    assert io.load_model(f"{tmpdir_path}/models/{out['best_model']}") is not None
    rf = rule_forecast(spark, ctx.features, ctx.star, tmpdir_path + "/rule", horizon=5,
                       family_to_category=ctx.family_to_category)
    assert rf.count() == series * 5


def test_year_filter_prunes_partitions_of_stored_facts(spark, tmpdir_path):
    from salescast.operators import joins, measures as me
    from salescast.plans.prepare import prepare
    ctx = Context(spark, SF_SMALL)
    stored = prepare(spark, ctx.raw.as_dict(), tmpdir_path, ctx.family_to_category, ctx.state_to_region)
    where = {"dim_date": F.col("year") == 1998}
    s = joins.apply_context(stored, where)
    import re
    plan = s.fact_sales._jdf.queryExecution().executedPlan().toString()
    # year partitions are pruned: statically (constraint inferred through the
    # semi join) or dynamically (a pruning subquery)
    assert re.search(r"PartitionFilters: \[[^\]]*year", plan) or "dynamicpruning" in plan.lower()
    a = me.total(stored, "revenue", ["category"], where=where).orderBy("category").collect()
    b = me.total(ctx.star, "revenue", ["category"], where=where).orderBy("category").collect()
    assert a == b


def test_raw_csv_files_to_star_end_to_end(spark, tmpdir_path):
    """E1: five raw CSV files -> typed reads -> features -> star on storage."""
    from salescast.plans.prepare import prepare
    ctx = Context(spark, SF_SMALL)
    raw = ctx.raw.as_dict()
    d = os.path.join(tmpdir_path, "raw")
    io.write_csv(raw["train"].select(F.monotonically_increasing_id().alias("id"), "date", "store_nbr", "family",
                                     "sales", "onpromotion").coalesce(1), f"{d}/train.csv")
    io.write_csv(raw["stores"].coalesce(1), f"{d}/stores.csv")
    io.write_csv(raw["oil"].coalesce(1), f"{d}/oil.csv")
    io.write_csv(raw["holidays"].select("date", F.lit("Holiday").alias("type"), F.lit("National").alias("locale"),
                                        F.lit("Ecuador").alias("locale_name"), F.lit("event").alias("description"),
                                        "transferred").coalesce(1), f"{d}/holidays_events.csv")
    io.write_csv(raw["transactions"].coalesce(1), f"{d}/transactions.csv")
    loaded = io.load_raw_csv(spark, d)
    star = prepare(spark, loaded, os.path.join(tmpdir_path, "out"), ctx.family_to_category, ctx.state_to_region)
    got = star.fact_sales.agg(F.sum("revenue"), F.sum("margin"), F.count(F.lit(1))).first()
    want = ctx.star.fact_sales.agg(F.sum("revenue"), F.sum("margin"), F.count(F.lit(1))).first()
    assert tuple(got) == tuple(want)
    assert star.dim_date.count() == ctx.star.dim_date.count()


def test_command_line_prepare_train_score(spark, tmpdir_path):
    from salescast.plans import train_score
    from salescast.plans.prepare import prepare
    ctx = Context(spark, SF_SMALL)
    processed = os.path.join(tmpdir_path, "processed")
    prepare(spark, ctx.raw.as_dict(), processed, ctx.family_to_category, ctx.state_to_region)
    train_score.main(["score", processed, os.path.join(tmpdir_path, "demo"), "--demo", "--horizon", "3"])
    demo = spark.read.parquet(os.path.join(tmpdir_path, "demo", "forecasts", "fact_forecasts.parquet"))
    assert demo.count() == ctx.features.select("store_nbr", "family").distinct().count() * 3
    feats = spark.read.parquet(os.path.join(processed, "features"))
    from salescast.plans.prepare import load_star
    star = load_star(spark, os.path.join(processed, "star"))
    out = train_score.train_and_forecast(spark, feats, star, os.path.join(tmpdir_path, "trained"),
                                         {"DT": dict(kind="dt", maxDepth=3)}, horizon=3)
    scored = train_score.score_with_model(spark, feats, star, os.path.join(tmpdir_path, "trained", "models", "DT"),
                                          os.path.join(tmpdir_path, "scored"), horizon=3)
    assert scored.count() == out["fact_forecasts"].count()
