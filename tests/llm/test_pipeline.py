"""The pipeline on the smallest tables, stage by stage, against brute force."""

import collections

from pyspark.sql import functions as F

import corpus_pipeline
from salescast.session import materialize
from tests.llm.test_operators import SPACED, brute_leaks, brute_simhash

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, SF), name="pipeline-test")
        assert out.columns == docs.columns
        now = {r.doc_id: r.text for r in out.collect()}
        assert now.items() <= before.items() and out.count() == len(now)
        kept[name], docs, previous, before = now, out, before, now
        if name == "quality classifier":
            good = [d for d in previous if d in labels and labels[d].quality == 1]
            assert sum(d in now for d in good) > 0.95 * len(good)
            bad = [d for d in previous if d in labels and labels[d].quality == 0]
            assert sum(d in now for d in bad) < 0.3 * len(bad)
        if name == "toxicity":
            clean = [d for d in previous if d in labels and labels[d].toxic == 0]
            assert sum(d in now for d in clean) > 0.95 * len(clean)
        if name == "SimHash near-dedup":
            assert set(now) == {c for _, _, c in brute_simhash(list(previous.items()))}
        if name == "benchmark decontamination":
            assert set(now) == {r[0] for r in brute_leaks(list(previous.items()), items) if not r[5]}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    taken = collections.Counter()
    for r in mixed:
        taken[r.doc_id] += r.taken
    size = {d: len(SPACED.findall(t or "")) for d, t in before.items()}
    assert set(taken) <= set(before) and all(n <= 2 * size[d] for d, n in taken.items())
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)


def test_empty_documents_run_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name="pipeline-empty")
        assert docs.count() == 0
