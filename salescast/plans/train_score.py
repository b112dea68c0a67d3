"""Training and forecasting plans (the train -> evaluate -> score lifecycle).

    train_and_forecast(spark, features, star, out_dir)

1. encode categoricals (codes fitted on the training side), time split;
2. fit every candidate configuration (distributed MLlib fits, looped over
   configurations on the driver), score the holdout, metrics + leaderboard;
3. write the leaderboard CSV and the training-results JSON, save the best model;
4. score the next ``horizon`` days for every series (scoring frame with the
   transactions profile), clip / round, build ``fact_forecasts`` and export it
   with its weekly rollup.

``rule_forecast`` is the model-free path: the rule-based forecast over the
same scoring frame.  Only the leaderboard (one row per candidate) and fitted
models live on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.functions import fixed
from salescast.operators import forecast as fc
from salescast.operators.ml import encode, evaluate as ev, split, train as tr
from salescast.session import materialize
from salescast.sources import io


def train_and_forecast(spark: SparkSession, features: DataFrame, star, out_dir: str,
                       candidates: dict | None = None, horizon: int = fixed.FORECAST_HORIZON_DAYS,
                       family_to_category=None, device: str = "spark") -> dict:
    root = out_dir.rstrip("/")
    candidates = candidates or {k: v for k, v in tr.CONFIGS.items()}
    train_raw, test_raw = split.time_split(features)
    enc = encode.fit_encoders(train_raw)
    train, test = (materialize(encode.prepare(x, enc), spark, "model-frame") for x in (train_raw, test_raw))

    rows = []
    for name, cfg in candidates.items():
        model, secs = tr.fit(train, cfg)
        m = ev.metrics(tr.evaluated(model, test)).select(F.lit(name).alias("model"), "*", F.lit(round(secs, 3)).alias("training_time"))
        rows.append(m.first())  # one row per candidate
        io.save_model(model, f"{root}/candidates/{name}")
        schema = m.schema
    lb = ev.leaderboard(spark.createDataFrame(rows, schema)).orderBy("rank").coalesce(1).cache()
    io.write_csv(lb.drop("is_best"), f"{root}/leaderboard")
    n_rows = features.agg(F.count(F.lit(1))).scalar()
    io.write_results(io.results_frame(lb, device, n_rows), f"{root}/training_results")
    best = lb.where(F.col("rank") == 1).select("model").first()["model"]
    model = io.load_model(f"{root}/candidates/{best}")
    io.save_model(model, f"{root}/models/{best}")
    encode.save(enc, f"{root}/models/{best}-encoders")

    frame = fc.scoring_frame(star, features, horizon, transactions="profile")
    prepared = encode.prepare(frame.withColumn("__family", F.col("family")), enc)
    scored = fc.score(model, prepared).drop("family").withColumnRenamed("__family", "family")
    ff = fc.fact_forecasts(scored, star.dim_product, family_to_category)
    fc.export_forecasts(ff, f"{root}/forecasts")
    return {"best_model": best, "leaderboard": lb, "fact_forecasts": spark.read.parquet(
        f"{root}/forecasts/fact_forecasts.parquet")}


def rule_forecast(spark: SparkSession, features: DataFrame, star, out_dir: str,
                  horizon: int = fixed.FORECAST_HORIZON_DAYS, noise: float = fixed.DEMO_NOISE_SD,
                  seed: int = 42, family_to_category=None) -> DataFrame:
    frame = fc.scoring_frame(star, features, horizon)
    ff = fc.fact_forecasts(fc.demo_forecast(frame, noise=noise, seed=seed), star.dim_product, family_to_category)
    root = out_dir.rstrip("/")
    fc.export_forecasts(ff, f"{root}/forecasts")
    return spark.read.parquet(f"{root}/forecasts/fact_forecasts.parquet")


def score_with_model(spark: SparkSession, features: DataFrame, star, model_dir: str, out_dir: str,
                     horizon: int = fixed.FORECAST_HORIZON_DAYS, family_to_category=None) -> DataFrame:
    """Score the next ``horizon`` days with a saved model and the code tables
    that were saved with it, whatever has been added to the features since."""
    model = io.load_model(model_dir)
    enc = encode.load(spark, f"{model_dir.rstrip('/')}-encoders")
    frame = fc.scoring_frame(star, features, horizon, transactions="profile")
    prepared = encode.prepare(frame.withColumn("__family", F.col("family")), enc)
    scored = fc.score(model, prepared).drop("family").withColumnRenamed("__family", "family")
    ff = fc.fact_forecasts(scored, star.dim_product, family_to_category)
    root = out_dir.rstrip("/")
    fc.export_forecasts(ff, f"{root}/forecasts")
    return spark.read.parquet(f"{root}/forecasts/fact_forecasts.parquet")


def main(argv: list[str] | None = None) -> None:
    """``python -m salescast.plans.train_score {train,score} PROCESSED_DIR OUT_DIR
    [--horizon N] [--demo] [--model PATH]`` over the output of ``plans.prepare``."""
    import argparse

    from salescast.plans.prepare import load_star
    from salescast.session import get_session, size_shuffles

    ap = argparse.ArgumentParser(prog="salescast.plans.train_score")
    ap.add_argument("command", choices=["train", "score"])
    ap.add_argument("processed_dir")
    ap.add_argument("out_dir")
    ap.add_argument("--horizon", type=int, default=fixed.FORECAST_HORIZON_DAYS)
    ap.add_argument("--demo", action="store_true", help="rule-based forecast instead of a model")
    ap.add_argument("--model", help="saved model folder for `score`")
    args = ap.parse_args(argv)

    spark = get_session()
    size_shuffles(spark, [args.processed_dir])
    features = spark.read.parquet(f"{args.processed_dir.rstrip('/')}/features")
    star = load_star(spark, f"{args.processed_dir.rstrip('/')}/star")
    if args.command == "train":
        train_and_forecast(spark, features, star, args.out_dir, horizon=args.horizon)
    elif args.demo or not args.model:
        rule_forecast(spark, features, star, args.out_dir, horizon=args.horizon)
    else:
        score_with_model(spark, features, star, args.model, args.out_dir, horizon=args.horizon)


if __name__ == "__main__":
    main()
