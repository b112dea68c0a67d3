"""Per-session context: raw test views -> cleaned -> features -> star.

Every registered query builds its plan from the driver tables through this
context, so its work grows with the input tables.  The feature table and the
two facts are reused by many branches of one plan (dimensions, facts, scoring
frame, scalar totals); they are materialized once as Parquet tables written
under the session's shared checkpoint folder, so the raw join and aggregation run
once per session and data set instead of once per branch.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.functions import fixed
from salescast.operators import star as starmod
from salescast.session import materialize
from salescast.sources import testviews

_SHARED: dict[tuple, "Context"] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, time and length of every file of the tables, as the tables' own
    file system lists them; nothing is shared where that cannot be asked."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # a Spark Connect session has no JVM handle
        return (object(),)
    out = []
    for t in testviews.TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getModificationTime(), f.getLen()))
    return tuple(sorted(out))


def _stopped(spark: SparkSession) -> bool:
    """Whether a classic session's context has ended."""
    try:
        return spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped()
    except Exception:  # a Spark Connect session has no context here
        return False


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._models: dict = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Context":
        """One context per (session, data set); rebuilt when files change."""
        key = (id(spark), spark.conf.get("spark.app.id", ""), sf_dir, _fingerprint(spark, sf_dir))
        ctx = _SHARED.get(key)
        if ctx is None:
            for old in [k for k, c in _SHARED.items() if _stopped(c.spark)]:
                del _SHARED[old]
            ctx = _SHARED[key] = cls(spark, sf_dir)
        return ctx

    def table(self, name: str) -> DataFrame:
        return testviews.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> testviews.RawTables:
        return testviews.raw_tables(self.spark, self.sf_dir)

    @cached_property
    def cleaned(self) -> dict[str, DataFrame]:
        """The derived ``train`` view (the big line-item join and aggregation)
        is read twice — for the rows and for the date range of the oil
        series — so it is materialized once first."""
        raw = self.raw.as_dict()
        raw["train"] = materialize(raw["train"], self.spark, "train")
        return starmod.load_raw(raw)

    @cached_property
    def features(self) -> DataFrame:
        return materialize(starmod.features(self.cleaned), self.spark, "features")

    @property
    def family_to_category(self) -> dict:
        return self.raw.family_to_category

    @property
    def state_to_region(self) -> dict:
        return self.raw.state_to_region

    @cached_property
    def star(self) -> starmod.Star:
        """Dimensions (derived from the written feature table) and the fact are
        written once, so that joins are planned from their files' sizes."""
        s = starmod.build_star(self.features, self.family_to_category, self.state_to_region)
        dims = {n: materialize(getattr(s, n), self.spark, n) for n in ("dim_date", "dim_store", "dim_product")}
        fact = starmod.build_fact_sales(self.features, dims["dim_product"], self.family_to_category)
        return s.replace(fact_sales=materialize(fact, self.spark, "fact_sales"), **dims)

    @cached_property
    def forecast_star(self) -> starmod.Star:
        """Star with ``fact_forecasts`` from the rule forecast at noise 0."""
        from salescast.operators import forecast as fc
        frame = fc.scoring_frame(self.star, self.features)
        preds = fc.demo_forecast(frame, noise=0.0)
        ff = fc.fact_forecasts(preds, self.star.dim_product, self.family_to_category)
        return self.star.replace(fact_forecasts=materialize(ff, self.spark, "fact_forecasts"))

    @cached_property
    def backtest_star(self) -> starmod.Star:
        """Star whose ``fact_forecasts`` is the rule forecast (noise 0) over
        the holdout window — the last 90 days of actual rows — so actuals and
        forecasts overlap (MAPE, matching, accuracy by grain)."""
        from salescast.operators import forecast as fc
        feats = self.features
        cutoff = F.date_sub(feats.agg(F.max("date")).scalar(), fixed.HOLDOUT_DAYS)
        preds = fc.demo_forecast(feats.where(F.col("date") > cutoff), noise=0.0)
        ff = fc.fact_forecasts(preds, self.star.dim_product, self.family_to_category)
        return self.star.replace(fact_forecasts=materialize(ff, self.spark, "fact_forecasts"))

    @cached_property
    def model_frames(self):
        """(train, test, encoders) for the models: time split at max(date) − 90
        days, label codes fitted on the training side, features prepared."""
        from salescast.operators.ml import encode, split
        train_raw, test_raw = split.time_split(self.features)
        enc = encode.fit_encoders(train_raw)
        return (materialize(encode.prepare(train_raw, enc), self.spark, "train"),
                materialize(encode.prepare(test_raw, enc), self.spark, "test"), enc)

    def fitted(self, name: str):
        """(model, seconds) of a configuration, fitted once a context on the
        written training frame."""
        from salescast.operators.ml import train
        if name not in self._models:
            self._models[name] = train.fit(self.model_frames[0], train.CONFIGS[name])
        return self._models[name]

    def fit_all(self, names) -> None:
        """Fits what is not fitted yet, all at once: the rounds of a boosting run
        wait for each other and leave cores free."""
        from concurrent.futures import ThreadPoolExecutor
        self.model_frames  # before the threads, so that they are made once
        missing = [n for n in names if n not in self._models]
        with ThreadPoolExecutor(max_workers=max(1, len(missing))) as pool:
            list(pool.map(self.fitted, missing))
