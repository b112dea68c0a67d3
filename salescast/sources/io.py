"""Typed readers and writers and the BI load transforms (IO9).

Every CSV read has an explicit schema and FAILFAST mode; Parquet reads take
an optional column list, which Catalyst prunes into the scan's ReadSchema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# IO1: schemas of the five raw retail CSVs
RAW_SCHEMAS = {
    "train": T.StructType([
        T.StructField("id", T.LongType()), T.StructField("date", T.DateType()),
        T.StructField("store_nbr", T.IntegerType()), T.StructField("family", T.StringType()),
        T.StructField("sales", T.DoubleType()), T.StructField("onpromotion", T.IntegerType())]),
    "stores": T.StructType([
        T.StructField("store_nbr", T.IntegerType()), T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()), T.StructField("type", T.StringType()),
        T.StructField("cluster", T.IntegerType())]),
    "oil": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("dcoilwtico", T.DoubleType())]),
    "holidays_events": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("type", T.StringType()),
        T.StructField("locale", T.StringType()), T.StructField("locale_name", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("transferred", T.BooleanType())]),
    "transactions": T.StructType([
        T.StructField("date", T.DateType()), T.StructField("store_nbr", T.IntegerType()),
        T.StructField("transactions", T.IntegerType())]),
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """IO1: header CSV with a fixed schema and ISO dates."""
    return (spark.read.schema(schema).option("header", True).option("mode", mode)
            .option("dateFormat", "yyyy-MM-dd").csv(path))


def load_raw_csv(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """IO1 for the five raw files; holiday events are reduced to the two
    columns the pipeline reads."""
    d = raw_dir.rstrip("/")
    train = read_csv(spark, f"{d}/train.csv", RAW_SCHEMAS["train"]).drop("id")
    hol = read_csv(spark, f"{d}/holidays_events.csv", RAW_SCHEMAS["holidays_events"])
    return {
        "train": train,
        "stores": read_csv(spark, f"{d}/stores.csv", RAW_SCHEMAS["stores"]),
        "oil": read_csv(spark, f"{d}/oil.csv", RAW_SCHEMAS["oil"]),
        "holidays": hol.select("date", "transferred"),
        "transactions": read_csv(spark, f"{d}/transactions.csv", RAW_SCHEMAS["transactions"]),
    }


def read_parquet(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """IO2: Parquet with an optional column subset."""
    return select_columns(spark.read.parquet(path), cols)


def select_columns(df: DataFrame, cols: Sequence[str] | None) -> DataFrame:
    return df if cols is None else df.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO3 / IO7: header CSV, no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_star(star, path: str, features: DataFrame | None = None) -> None:
    """IO4: one Parquet folder per star table; facts partitioned by year so a
    year filter prunes files and each task writes a bounded slice."""
    root = path.rstrip("/")
    for name, df in star.tables().items():
        if df is None:
            continue
        if name.startswith("fact_"):
            df = df.withColumn("year", F.year("date"))
            write_parquet(by_year(df, "date_key"), f"{root}/{name}", ["year"])
        else:
            write_parquet(df, f"{root}/{name}")
    if features is not None:
        write_parquet(by_year(features, "date"), f"{root}/features", ["year"])


def write_star_csv(star, path: str, features: DataFrame | None = None) -> None:
    """IO4, CSV form: one folder per table, and the flat training table."""
    root = path.rstrip("/")
    for name, df in {**star.tables(), "features": features}.items():
        if df is not None:
            write_csv(df, f"{root}/{name}.csv")


def by_year(df: DataFrame, order: str) -> DataFrame:
    """Rows brought together by year in partitions of about the advisory size
    (a year that is larger is split over several), sorted by ``order``."""
    return df.hint("rebalance", "year").sortWithinPartitions("year", order)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def sample_n(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """IO5: ``min(n, rows)`` rows chosen by an MD5 of the seed and the keys — a
    deterministic top-n (TakeOrderedAndProject keeps n rows per task)."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), *keys).limit(n)


RESULTS_SCHEMA = T.StructType([
    T.StructField("best_model", T.StringType()),
    T.StructField("metrics", T.StructType([
        T.StructField("model", T.StringType()), T.StructField("normalized_rmse", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()), T.StructField("mae", T.DoubleType()),
        T.StructField("mape", T.DoubleType()), T.StructField("r2", T.DoubleType()),
        T.StructField("training_time", T.DoubleType())])),
    T.StructField("all_models", T.ArrayType(T.StructType([
        T.StructField("model", T.StringType()), T.StructField("normalized_rmse", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()), T.StructField("mae", T.DoubleType()),
        T.StructField("mape", T.DoubleType()), T.StructField("r2", T.DoubleType()),
        T.StructField("training_time", T.DoubleType())]))),
    T.StructField("training_device", T.StringType()),
    T.StructField("dataset_rows", T.LongType()),
])


def results_frame(leaderboard: DataFrame, device: str, dataset_rows) -> DataFrame:
    """IO6: the training-results record as a one-row DataFrame, built from the
    (small, one row per model) leaderboard with aggregate functions."""
    m = F.struct("model", "normalized_rmse", "rmse", "mae", "mape", "r2", "training_time")
    return leaderboard.agg(
        F.min_by("model", F.struct("normalized_rmse", "model")).alias("best_model"),
        F.min_by(m, F.struct("normalized_rmse", "model")).alias("metrics"),
        F.sort_array(F.collect_list(F.struct(F.col("normalized_rmse").alias("k"), m.alias("v"))))
         .alias("__all"),
    ).select("best_model", "metrics", F.transform("__all", lambda x: x["v"]).alias("all_models"),
             F.lit(device).alias("training_device"),
             (dataset_rows if hasattr(dataset_rows, "_jc") else F.lit(dataset_rows)).cast("long").alias("dataset_rows"))


def write_results(results: DataFrame, path: str) -> None:
    results.coalesce(1).write.mode("overwrite").json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULTS_SCHEMA).json(path)


def save_model(model, path: str) -> None:
    """IO8: persistence of MLlib pipelines and of tree ensembles (on any
    Hadoop-compatible path)."""
    from pyspark.sql import SparkSession

    from salescast.operators.ml.trees import Ensemble
    if isinstance(model, Ensemble):
        model.save(SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str):
    """The model saved at ``path``, of the kind that was saved."""
    from pyspark.ml import PipelineModel
    from pyspark.sql import SparkSession

    from salescast.operators.ml.trees import Ensemble
    spark = SparkSession.active()
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ensemble")
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return Ensemble.load(spark, path)
    return PipelineModel.load(path)


# IO9 + PR8–PR11: the BI tool's load transforms ------------------------------
def load_fact(df: DataFrame, kind: str) -> DataFrame:
    """Drop the raw ``date`` (ignored when absent); ``sales`` facts get
    ``has_promotion``, ``forecasts`` facts get ``data_source = 'Forecast'``."""
    df = df.drop("date")
    if kind == "sales":
        return df.withColumn("has_promotion", F.col("onpromotion") > 0)
    return df.withColumn("data_source", F.lit("Forecast"))


def load_dim(df: DataFrame, kind: str) -> DataFrame:
    if kind == "store":
        return df.withColumn("store_label", F.concat(F.lit("Store "), F.col("store_nbr").cast("string"),
                                                     F.lit(" - "), F.col("city")))
    if kind == "date":
        return (df.drop("date").withColumn("month_sort", F.col("month"))
                  .withColumn("day_sort", F.col("day_of_week")))
    return df
