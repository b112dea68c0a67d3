"""ST1: continuous scoring of incoming feature rows with Structured Streaming.

Requests (one row per date × store × family, the scoring-frame columns) land
as files in a folder; the stream adds calendar columns, encodes categoricals,
applies the fitted model, clips / rounds and appends predictions to a sink.
That job is stateless, so it needs no watermark; its progress lives in the
checkpoint location under the session's shared checkpoint folder, and a
restarted or retried batch rewrites nothing twice (file sink + checkpoint).

``serve`` is the stateful form for requests that clients send as JSON lines, send
again, or send wrong: each request id is answered once, and what cannot be scored
goes to a dead-letter folder with the reason, instead of failing its batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.functions import calendar as cal
from salescast.operators.ml import encode

REQUEST_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("store_nbr", T.IntegerType()),
    T.StructField("family", T.StringType()), T.StructField("onpromotion", T.IntegerType()),
    T.StructField("oil_price", T.DoubleType()), T.StructField("is_holiday", T.IntegerType()),
    T.StructField("transactions", T.DoubleType()), T.StructField("oil_price_lag7", T.DoubleType()),
    T.StructField("city", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("type", T.StringType()), T.StructField("cluster", T.IntegerType()),
])


def request_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    return (spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", max_files)
            .parquet(path))


def score_stream(requests: DataFrame, model, encoders: dict[str, DataFrame]) -> DataFrame:
    """Stream -> scored stream (the encoders are small static frames; a
    stream-static join per categorical column)."""
    feats = requests.withColumns(cal.calendar_features("date"))
    keep = feats.withColumn("__family", F.col("family"))
    prepared = encode.prepare(keep, encoders)
    scored = model.transform(prepared)
    return scored.select("date", F.col("store_nbr").cast("int").alias("store_nbr"),
                         F.col("__family").alias("family"),
                         cal.post_process("prediction").alias("predicted_sales"))


def start(scored: DataFrame, out_path: str, checkpoint: str, available_now: bool = False):
    w = (scored.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


#: What a JSON request holds besides the scoring columns, and what it must have.
ENVELOPE = T.StructType([T.StructField("request_id", T.StringType()), *REQUEST_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
REQUIRED = {"request_id": "no request id", "date": "no date", "store_nbr": "no store", "family": "no family"}


def parse(lines: DataFrame) -> DataFrame:
    """JSON lines -> envelope columns, ``raw``, and ``reason``: why a line cannot
    be scored, NULL for good ones."""
    request = F.from_json("value", ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "dateFormat": "yyyy-MM-dd"})
    rows = lines.select(F.col("value").alias("raw"), request.alias("r")).select("raw", "r.*")
    reason = F.when(F.col("_corrupt").isNotNull(), F.lit("not JSON"))
    for name, why in REQUIRED.items():
        reason = reason.when(F.col(name).isNull(), F.lit(why))
    return rows.withColumn("reason", reason).drop("_corrupt")


def once(requests: DataFrame, within: str = "1 hour") -> DataFrame:
    """Each request once: of those with one id that arrive within the time of the
    first, only that one; of bad ones, of the same line.  A bad request does not
    use up its id, so a mended one is answered.  The state forgets ids after the
    time, which bounds it by the rate of requests; arrival time is fixed by batch,
    so no request is ever late, and a replayed batch sees the same times."""
    key = F.when(F.col("reason").isNull(), F.concat(F.lit("id:"), F.col("request_id"))).otherwise(F.concat(F.lit("raw:"), F.sha2("raw", 256)))
    timed = requests.withColumn("received_at", F.current_timestamp()).withColumn("request_key", key)
    return timed.withWatermark("received_at", within).dropDuplicatesWithinWatermark(["request_key"]).drop("request_key")


def serve(spark: SparkSession, path: str, out_path: str, dead_path: str, checkpoint: str, model, encoders: dict[str, DataFrame],
          within: str = "1 hour", max_files: int = 100, available_now: bool = False):
    """Starts the job: answers below ``out_path`` (request_id, date, store_nbr,
    family, predicted_sales), dead letters below ``dead_path`` (raw, reason).

    A batch writes folders of its own number, in place of what an attempt at the
    same batch left; the checkpoint holds the ids and the batches done.  So a job
    that is stopped anywhere and started again answers each request once."""
    requests = once(parse(spark.readStream.option("maxFilesPerTrigger", max_files).text(path)), within)

    def land(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        good = batch.where("reason is null").withColumns(cal.calendar_features("date")).withColumn("__family", F.col("family"))
        scored = model.transform(encode.prepare(good, encoders)).select(
            "request_id", "date", F.col("store_nbr").cast("int").alias("store_nbr"), F.col("__family").alias("family"),
            cal.post_process("prediction").alias("predicted_sales"))
        scored.write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        batch.where("reason is not null").select("raw", "reason").write.mode("overwrite").parquet(f"{dead_path}/batch={number}")
        batch.unpersist()

    w = requests.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
