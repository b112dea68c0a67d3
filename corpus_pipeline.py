"""A training-corpus pipeline over ``documents``: each stage takes the documents
that its predecessor kept, and is written as Parquet and read again before the
next, so that a lost executor re-reads files and no lineage grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm import decontaminate, mixing, quality, simhash, toxicity
from salescast.llm import text as tx
from salescast.session import materialize


def learnable():
    """Labels that may be learned from."""
    return tx.crc_fold(F.col("doc_id"), 5) != 0


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the positive-unlabelled model scores at its
    threshold or above; the labels of documents that are not there are unused."""
    _, model = quality.score(docs, labels(spark, sf_dir), learnable())
    found, score = quality.apply(docs, model)
    return found.where(score >= quality.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose toxicity is below the threshold."""
    _, machine = toxicity.score(docs, labels(spark, sf_dir), learnable())
    found, name = toxicity.decisions(docs, machine)
    clean = machine.probability(F.col(name)["decision"], F.col(name)["hits"]) < toxicity.THRESHOLD
    return found.where(clean).select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group, the one with the smallest id."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a verified benchmark window."""
    found, name = decontaminate.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.clean(found, name)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, once for each pass that takes words of
    them, with epoch, taken and position."""
    return mixing.mix(docs, keep=True)[0]


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_to_weights),
]

#: Fitted models and SimHash are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), spark, f"pipeline-{k}")
    return docs
