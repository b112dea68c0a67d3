"""Token counts through a digest cache.

The cache is a Parquet table of (tokenizer digest, text digest, n_tokens).
Documents are joined to it by digest; only distinct texts that it lacks are
encoded, and their counts are appended.  The join that returns the counts reads
the cache after the append, so a rerun after a failure encodes what is missing.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.session import materialize

CACHE = T.StructType([T.StructField("tokenizer", T.StringType()), T.StructField("digest", T.StringType()),
                      T.StructField("n_tokens", T.LongType())])
LIMIT = 1024


def version(path: str) -> str:
    """Digest of the tokenizer's library, its version and its file."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        head = f"{library.__name__} {library.__version__} ".encode()
        return hashlib.sha256(head + f.read()).hexdigest()


def separable(tokenizer: dict) -> bool:
    """Whether counts of this tokenizer add up over pieces cut before a space
    that stands between two characters that are no white space.

    True of the byte-level pre-tokenizer with its own pattern: the pattern takes
    a space only at the start of a match or in a run of white space, so a match
    always begins at such a space, and its look-ahead past white space sees the
    same there and at the end of a piece.  Nothing may rewrite the text before,
    and no added token may hold white space or look at its neighbours.
    """
    before = tokenizer.get("pre_tokenizer") or {}
    own = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
    plain = tokenizer.get("normalizer") is None and not (tokenizer.get("model") or {}).get("dropout")
    added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) for t in tokenizer.get("added_tokens") or [])
    return bool(own and plain and added)


class Pieces:
    """Counts of texts as sums over their pieces.  A worker remembers the counts
    of up to ``KNOWN`` short pieces, and begins anew when these are full."""

    #: Remembered pieces, and characters of the longest of them (longer ones are counted each time).
    KNOWN, LONGEST = 1_000_000, 64
    #: White space beside a single space, or more than one, or at an end: cut with care.
    UNCLEAN = re.compile(r"\s\s|^\s|\s$")
    CUT = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, encode):
        self.encode, self.known = encode, {}

    def __call__(self, texts: list[str]) -> list[int]:
        # a piece's own first space is left out: the first of a text has none, so it is counted apart
        cut = [t.split(" ") if not self.UNCLEAN.search(t) else self.CUT.split(t) for t in texts]
        out = self.encode([ps[0] for ps in cut])
        new = list(set().union(*(ps[1:] for ps in cut)).difference(self.known))
        if len(self.known) + len(new) > self.KNOWN:
            self.known, new = {}, list(set().union(*(ps[1:] for ps in cut)))
        self.known.update(zip(new, self.encode([" " + p for p in new])))
        out = [n + sum(map(self.known.__getitem__, ps[1:])) for n, ps in zip(out, cut)]
        for p in new:
            if len(p) > self.LONGEST:
                del self.known[p]
        return out


@functools.cache
def counter(path: str, own: str):
    """texts -> numbers of tokens, without added begin, end or special tokens,
    padding or truncation; one thread a task.  ``own`` is the version, so that
    a worker that is used again never counts by an older file."""
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    whole = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
    with open(path, encoding="utf-8") as f:
        return Pieces(whole) if separable(json.load(f)) else whole


def _count(batches, path, own):
    count = counter(path, own)
    for batch in batches:
        for piece in tx.pieces(batch, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(count(piece.column(1).to_pylist()), pa.int64())],
                                             names=["digest", "n_tokens"])


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The cache; empty where nothing was written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(CACHE).parquet(cache) if there else spark.createDataFrame([], CACHE)


def count(docs: DataFrame, cache: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
          limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``.

    ``cache`` is a folder that all executors share; ``tokenizer`` a vocabulary
    file at the same path on each of them.  A text is normalised by reading
    null as empty and by nothing else, as other changes could change its
    count.  Repeated texts are encoded once, whatever their number; null ids
    and repeated rows are returned as they come.  A text's digest is SHA-256
    over its bytes.
    """
    spark, own = docs.sparkSession, version(tokenizer)
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.sha2(body.cast("binary"), 256).alias("digest"))
    known = read_cache(spark, cache).where(F.col("tokenizer") == own).select("digest")
    # copies are dropped within each task before the shuffle, and then among tasks
    misses = keyed.select("digest", "text").dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    counted = misses.mapInArrow(lambda b: _count(b, tokenizer, own), T.StructType(CACHE.fields[1:]))
    counted.select(F.lit(own).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    # two writers may have added the same text; both counted the same.  Written, so that
    # the join below has no aggregate in its stages and Spark can split a hot digest
    found = read_cache(spark, cache).where(F.col("tokenizer") == own).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    found = materialize(found, spark, "token-counts")
    sized = keyed.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes"))
    return sized.join(found, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
