"""The subpackage's registered queries: ``fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm import (decontaminate, langid, licenses, mixing, oracle, pst, quality, rules, simhash, spelling, tiles,
                           token_counts, toxicity, whitening)
from salescast.llm import text as tx
from salescast.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark, sf_dir):
    """Verified benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(*decontaminate.find(docs, table(spark, sf_dir, "benchmark")))


def op2_pst_score(spark, sf_dir):
    """Suffix-tree log10 probability of every document."""
    docs = table(spark, sf_dir, "documents")
    return pst.score(docs, tx.crc_fold(F.col("doc_id"), 7) != 2)


def op3_simhash(spark, sf_dir):
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.cluster(table(spark, sf_dir, "documents"))


def op4_mixing(spark, sf_dir):
    """Words that the mix takes of every document, summed over the dealt and
    position-sorted occurrences (``mixing.deal`` also has their positions)."""
    _, report = mixing.deal(table(spark, sf_dir, "documents"))
    return report.select("doc_id", "size", "source_size", "target", "taken")


def op5_licenses(spark, sf_dir):
    """Licence phrases and templates in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.digest(*licenses.find(docs))


def op6_quality(spark, sf_dir):
    """Quality score of every document, learned from positives and unlabelled text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, _ = quality.score(docs, table(spark, sf_dir, "labels"), tx.crc_fold(F.col("doc_id"), 5) != 0)
    return scored.select("doc_id", held_out(5, 0), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op7_token_counts(spark, sf_dir):
    """Token counts of every document, through a cache of this run's own."""
    from public_tokenizers import path as tokenizer_path
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cache = f"{shared_folder(spark).rstrip('/')}/token-cache-{uuid.uuid4().hex}"
    return token_counts.count(docs, cache, tokenizer_path("byte_bpe_50k.json"))


def op8_quality_rules(spark, sf_dir):
    """Rule statistics of every document, and the verdict of certified cutoffs."""
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("rejected_by")


def op9_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, _ = toxicity.score(docs, table(spark, sf_dir, "labels"), tx.crc_fold(F.col("doc_id"), 5) != 0)
    return scored.select("doc_id", held_out(5, 0), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_language(spark, sf_dir):
    """Language of every document."""
    found, name = langid.identify(table(spark, sf_dir, "documents"), tx.crc_fold(F.col("doc_id"), 3) != 1)
    return found.select("doc_id", held_out(3, 1), F.col(name)["lang"].alias("lang_pred"), F.col(name)["score"].alias("score"))


def op11_vector_dedup(spark, sf_dir):
    """Links and component of every vector among those of its label."""
    return tiles.near(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op12_whitening(spark, sf_dir):
    """Leading whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_spelling(spark, sf_dir):
    """Spelling variants among the words of all documents."""
    return spelling.group(table(spark, sf_dir, "documents").select("doc_id", "text"))


def held_out(folds: int, remainder: int):
    """Rows whose labels are not learned from; a null id has no labels."""
    return F.coalesce(tx.crc_fold(F.col("doc_id"), folds) == remainder, F.lit(False)).alias("held_out")


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_pst_score, op3_simhash, op4_mixing, op5_licenses, op6_quality,
                                   op7_token_counts, op8_quality_rules, op9_toxicity, op10_language,
                                   op11_vector_dedup, op12_whitening, op13_spelling)}
ORACLE = {"op1_decontaminate": oracle.DECONTAMINATE, "op4_mixing": oracle.MIX, "op8_quality_rules": oracle.RULES,
          "op11_vector_dedup": oracle.NEAR_VECTORS, "op13_spelling": oracle.SPELLING}
