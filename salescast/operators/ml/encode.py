"""ML1 / ML2: label encoding and feature assembly.

Codes are 0-based positions in ascending string order (the same codes a
label encoder fitted on the training frame gives); at scoring time a value
never seen in training gets code 0.  The code tables hold one row per
distinct category, and are joined like any small dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions import fixed


def label_codes(df: DataFrame, col: str) -> DataFrame:
    """(value, code) for one column; code = rank in sorted distinct values - 1
    (distributed dense numbering, ``operators.keys``)."""
    from salescast.operators.keys import dense_keys
    return dense_keys(df, col, "code", start=0, as_string=True).withColumnRenamed(col, "value")


def fit_encoders(df: DataFrame, cols: Sequence[str] = fixed.CATEGORICAL_COLS) -> dict[str, DataFrame]:
    return {c: label_codes(df, c) for c in cols}


def save(encoders: dict[str, DataFrame], path: str) -> None:
    """One code table per column, beside the model that was fitted with them."""
    for c, codes in encoders.items():
        codes.write.mode("overwrite").parquet(f"{path}/{c}")


def load(spark, path: str, cols: Sequence[str] = fixed.CATEGORICAL_COLS) -> dict[str, DataFrame]:
    return {c: spark.read.parquet(f"{path}/{c}") for c in cols}


def encode(df: DataFrame, encoders: dict[str, DataFrame]) -> DataFrame:
    """Replace each categorical column by its code (unseen -> 0)."""
    out = df
    for c, codes in encoders.items():
        k = codes.select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__c_{c}"))
        out = (out.join(k, out[c].cast("string") == k[f"__v_{c}"], "left")
                  .withColumn(c, F.coalesce(F.col(f"__c_{c}"), F.lit(0)))
                  .drop(f"__v_{c}", f"__c_{c}"))
    return out


def assembler(cols: Sequence[str] = fixed.FEATURE_COLS, out: str = "features") -> VectorAssembler:
    """ML2: the 20 feature columns in fixed order; NULL features are filled
    with 0 before assembly (PR12)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def prepare(df: DataFrame, encoders: dict[str, DataFrame], cols: Sequence[str] = fixed.FEATURE_COLS) -> DataFrame:
    """Encode, cast to double and fill NULL features with 0."""
    enc = encode(df, encoders)
    enc = enc.withColumns({c: F.col(c).cast("double") for c in cols})
    return enc.fillna(0.0, subset=list(cols))
