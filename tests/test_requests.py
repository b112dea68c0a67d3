"""The request stream: each request once over restarts, bad ones set aside."""

import json

import pytest
from pyspark.sql import functions as F

from salescast.streaming import scoring


class Model:
    """Predicts the store's number plus a half; counts its calls."""

    def transform(self, df):
        return df.withColumn("prediction", F.col("store_nbr") + 0.5)


class Broken(Model):
    """Ends the job in the batch that holds store 13, after the answers of others."""

    def transform(self, df):
        return super().transform(df).withColumn("prediction", F.when(F.col("store_nbr") == 13, F.raise_error(F.lit("lost"))).otherwise(F.col("prediction")))


def line(i, **more):
    return json.dumps({"request_id": f"r{i}", "date": "2017-08-16", "store_nbr": i, "family": "A", "onpromotion": 1, "oil_price": 1.0,
                       "is_holiday": 0, "transactions": 1.0, "oil_price_lag7": 1.0, "city": "x", "state": "y", "type": "z", "cluster": 1} | more)


def test_requests_are_answered_once_over_restarts(spark, tmpdir_path):
    encoders = {c: spark.createDataFrame([("A", 1)], "value string, code int") for c in ("family", "city", "state", "type")}
    put = lambda n, rows: spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(f"{tmpdir_path}/in")

    def go(model):
        q = scoring.serve(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/dead", f"{tmpdir_path}/check", model, encoders,
                          max_files=1, available_now=True)
        q.awaitTermination()

    put(1, [line(1), line(2), line(1), "{not json", "{not json", line(3, family=None), line(4)[:-1], line(5, date="never")])
    go(Model())
    put(2, [line(2), line(6), line(3)])  # one again, one new, and a bad one mended
    put(3, [line(13), line(7), line(1), "{}", line(None, request_id=None)])
    with pytest.raises(Exception, match="lost"):
        go(Broken())
    put(4, [line(8), line(13), line(6)])
    go(Model())  # the failed batch again, then the new file
    out = spark.read.parquet(f"{tmpdir_path}/out").collect()
    assert sorted(r.request_id for r in out) == ["r1", "r13", "r2", "r3", "r6", "r7", "r8"]
    assert all(r.predicted_sales == round(int(r.request_id[1:]) + 0.5) for r in out)
    dead = sorted((r.reason, r.raw) for r in spark.read.parquet(f"{tmpdir_path}/dead").collect())
    assert [r for r, _ in dead] == ["no family", "no request id", "no request id", "not JSON", "not JSON", "not JSON"]
    assert {raw for _, raw in dead} >= {"{not json", line(3, family=None), line(5, date="never"), "{}"}
