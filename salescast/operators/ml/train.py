"""ML4–ML7b: regressors behind one ``fit`` helper.

The configurations are the original models': boosted trees (1000 rounds, step
0.05, depth 8, at most 127 leaves, row and column subsampling 0.8, min 50 rows a
leaf, l1 and l2 0.1), a second boosted configuration (500 rounds, depth 8, min
20, l2 1), a random forest (200 trees, depth 15, min 20 rows a leaf, seed 42), an
elastic net (alpha 1.0, l1 ratio 0.5, 1000 iterations, no standardisation) and a
decision tree.  Boosting measures itself on the last 90 days of the training
window and stops after 50 rounds without a better one.  Boosting and forests are
``operators.ml.trees``; the linear model and the single tree are MLlib's.
"""

from __future__ import annotations

import threading
import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions import fixed
from salescast.operators.ml import trees
from salescast.operators.ml.encode import assembler

CONFIGS = {
    "GBT": dict(kind="boost", rounds=1000, patience=50, step=0.05, depth=8, max_leaves=127, min_rows=50, rows=0.8, columns=0.8,
                l1=0.1, l2=0.1, validation_days=90),
    "GBT-2": dict(kind="boost", rounds=500, patience=50, step=0.05, depth=8, min_rows=20, rows=0.8, columns=0.8, l2=1.0,
                  validation_days=90),
    "RandomForest": dict(kind="forest", trees=200, depth=15, min_rows=20, columns=1.0, bootstrap=True, seed=42),
    "ElasticNet": dict(kind="lr", regParam=1.0, elasticNetParam=0.5, maxIter=1000, tol=1e-4),
    "DecisionTree": dict(kind="dt", maxDepth=10, minInstancesPerNode=20),
}


class Shared:
    """What several fits on one frame need, made by the first that asks for it."""

    def __init__(self):
        self.lock, self.made = threading.Lock(), {}

    def get(self, name: str, make):
        with self.lock:
            if name not in self.made:
                self.made[name] = make()
            return self.made[name]


def bins(train: DataFrame, cols=fixed.CATEGORICAL_COLS) -> int:
    """Split points for every code of the widest categorical column."""
    have = [F.max(c) for c in cols if c in train.columns]
    if not have:
        return 64
    return max(64, int(train.agg(F.array_max(F.array(*have)).alias("n")).first()["n"] or 0) + 2)


def estimator(kind: str, label: str = "sales", max_bins: int = 64, **params):
    common = dict(featuresCol="features", labelCol=label, predictionCol="prediction")
    if kind == "gbt":
        return GBTRegressor(maxBins=max_bins, seed=params.pop("seed", 42), **common, **params)
    if kind == "rf":
        return RandomForestRegressor(maxBins=max_bins, **common, **params)
    if kind == "dt":
        return DecisionTreeRegressor(maxBins=max_bins, seed=params.pop("seed", 42), **common, **params)
    if kind == "lr":
        return LinearRegression(standardization=False, **common, **params)
    raise ValueError(kind)


def fit(train: DataFrame, config: dict, label: str = "sales",
        cols=fixed.FEATURE_COLS) -> tuple[PipelineModel | trees.Ensemble, float]:
    """Fit a configuration; returns the model and the fit seconds.

    Kinds ``boost`` and ``forest`` are ``operators.ml.trees``, the others MLlib
    pipelines of assembler and regressor.  Extra config keys:
      ``validation_days``  boosted trees only: rows in the last N days of the
                           training window are measured for stopping, not
                           learned from, so the holdout is never used for it.
      ``folder``           boost and forest: where the run writes its blocks or
                           groups, and goes on from what it finds there.
      ``stop``             boost and forest: asked between rounds or groups
                           whether to give up.
      ``shared``           a ``Shared`` of fits on the same frame.
    """
    params = dict(config)
    shared = params.pop("shared", None) or Shared()
    most = lambda: shared.get("bins", lambda: bins(train))
    kind = params.pop("kind")
    if kind in ("boost", "forest"):
        t0 = time.time()
        own = {k: params.pop(k) for k in ("rounds", "patience", "trees", "folder", "group", "stop") if k in params}
        days = params.pop("validation_days", None)
        if days:
            own["validation"] = F.col("date") > F.date_sub(train.agg(F.max("date")).scalar(), days)
        make, n = trees.boost if kind == "boost" else trees.forest, min(255, most())
        made = lambda: shared.get("edges", lambda: trees.edges(train, cols, n))
        return make(train, cols, label, trees.Params(**params), bins=n, made=made, **own), time.time() - t0
    val_days = params.pop("validation_days", None)
    if val_days and kind == "gbt":
        cut = F.date_sub(train.agg(F.max("date")).scalar(), val_days)
        train = train.withColumn("is_validation", F.col("date") > cut)
        params.setdefault("validationIndicatorCol", "is_validation")
    if kind != "lr":
        params["max_bins"] = most()
    if kind in ("gbt", "rf"):
        params = {"cacheNodeIds": True, "checkpointInterval": 20, "maxMemoryInMB": 512, **params}
    pipe = Pipeline(stages=[assembler(cols), estimator(kind, label, **params)])
    t0 = time.time()
    model = pipe.fit(train)
    return model, time.time() - t0


def predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features")


def evaluated(model, df: DataFrame, label: str = "sales", keep=()) -> DataFrame:
    """(actual, predicted) rows for metrics: predictions are clipped at 0 and
    not rounded (only published forecasts are)."""
    return predict(model, df).select(*keep, F.col(label).alias("actual"), F.greatest("prediction", F.lit(0.0)).alias("predicted"))


def importance(spark, model, cols=fixed.FEATURE_COLS) -> DataFrame:
    """ML11: tree feature importances normalised to sum 1, largest first.

    The importance vector lives in the fitted model on the driver (20
    numbers); it becomes a 20-row DataFrame."""
    if isinstance(model, trees.Ensemble):
        imp = model.gains
    else:
        last = model.stages[-1]
        imp = last.featureImportances.toArray() if hasattr(last, "featureImportances") else [abs(x) for x in last.coefficients]
    total = float(sum(imp)) or 1.0
    rows = [(c, float(v) / total) for c, v in zip(cols, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
