"""Benchmark decontamination: a broadcast hash set of normalised n-grams of the
benchmark, scanned over whole documents; hits are verified word by word.

The benchmark is held in blocks of about ``block_windows`` distinct (window,
item) pairs, dealt by hash (a bound on what one broadcast holds, also where
many items share a window).  A benchmark within the bound is one
block and one scan without a shuffle; a larger one takes one scan per block,
and the scans' spans of a document are merged by document.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.session import materialize

#: Words in a window; shorter items (but not empty ones) are one window.
WINDOW = 10
#: Distinct (window, item) pairs in one broadcast block (about 100 bytes each).
BLOCK_WINDOWS = 1 << 18
FILTER_BITS = 22

SPAN = ("start", "end", "char_start", "char_end")
KIND = tx.struct_type(n_words=T.LongType(), n_hit=T.LongType(), items=T.ArrayType(T.StringType()),
                      spans=T.ArrayType(tx.struct_type(**{f: T.LongType() for f in SPAN})))


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """Distinct (window, item): n consecutive words, or all of a shorter item."""
    w = tx.words(tx.lower_ascii(F.col(text)), tx.PLAIN_WORD)
    at = F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0)))
    return (benchmark.where(F.col(item_id).isNotNull())
            .select(F.col(item_id).cast("string").alias("item"), w.alias("w")).where(F.size("w") > 0)
            .select("item", F.explode(F.transform(at, lambda i: F.array_join(F.slice("w", i + 1, n), " "))).alias("window"))
            .distinct())


class Block:
    """Windows of one broadcast: text -> items, and hashes by window length."""

    def __init__(self, rows):
        self.items = defaultdict(list)
        for window, item in rows:
            self.items[window.encode()].append(item)
        by_length = defaultdict(list)
        for window in self.items:
            by_length[window.count(b" ") + 1].append(window)
        self.hashes = {}
        for length, group in by_length.items():
            seen = tx.Words(pa.array([w.decode() for w in group], pa.large_string()))
            slots = np.zeros(1 << FILTER_BITS, bool)
            h = rolled(seen.hashes(), length)[seen.first[:-1]]
            slots[(h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
            self.hashes[length] = (slots, np.unique(h))


def rolled(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of the window of ``length`` words that starts at each word."""
    out = np.zeros(max(0, len(h) - length + 1), np.uint64)
    with np.errstate(over="ignore"):
        for p, k in zip(tx.powers(length, 0xD6E8FEB86659FD93), range(length)):
            out += h[k: len(out) + k] * p
        return out ^ (out >> np.uint64(31))


def scan(block: Block, column):
    """Per text: number of words, word spans that are hit, items that occur."""
    seen = tx.Words(column)
    h, last = seen.hashes(), np.repeat(seen.first[1:], seen.counts())
    spans, items = defaultdict(list), defaultdict(set)
    for length, (slots, known) in block.hashes.items():
        rolling = rolled(h, length)
        maybe = np.flatnonzero(slots[(rolling & np.uint64(len(slots) - 1)).astype(np.int64)])
        maybe = maybe[maybe + length <= last[maybe]]
        found = np.minimum(np.searchsorted(known, rolling[maybe]), len(known) - 1)
        maybe = maybe[known[found] == rolling[maybe]]
        owner = np.searchsorted(seen.first, maybe, "right") - 1
        for i, d in zip(maybe.tolist(), owner.tolist()):
            got = block.items.get(b" ".join(seen.word(k) for k in range(i, i + length)))
            if got:
                base = int(seen.first[d])
                spans[d].append((i - base, i + length - base))
                items[d].update(got)
    return seen, {d: merged(s) for d, s in spans.items()}, items


def merged(spans):
    out = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", n: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> tuple[DataFrame, str]:
    """``docs`` with a struct column: n_words, n_hit (words inside a verified
    window), items (distinct, sorted as strings) and the merged word spans
    with their character bounds.

    A null or empty text has no words and no hits; items without an id or
    without words have no windows; an empty benchmark hits nothing; repeated
    items and repeated documents each count for themselves.  Columns of
    ``docs`` stay as they are, whatever their names.
    """
    spark = docs.sparkSession
    sized = windows(benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")), n=n)
    blocks = max(1, -(-sized.count() // block_windows))
    # a window whose items lie in several blocks is found by each of their scans
    sized = sized.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    results = []
    for k in range(blocks):
        held = spark.sparkContext.broadcast(
            Block([(r.window, r.item) for r in sized.where(F.col("block") == k).select("window", "item").collect()]))

        def make(held=held):
            block = held.value

            def work(piece, at):
                seen, spans, items = scan(block, piece.column(at))
                count = seen.counts()
                rows = range(len(count))
                shaped = [[dict(zip(SPAN, (a, z, *characters(seen, d, a, z))))
                           for a, z in spans.get(d, [])] for d in rows]
                hit = [sum(z - a for a, z in spans.get(d, [])) for d in rows]
                return [pa.array(count, pa.int64()), pa.array(hit, pa.int64()),
                        pa.array([sorted(items.get(d, ())) for d in rows], pa.list_(pa.string())),
                        pa.array(shaped, pa.list_(pa.struct([(f, pa.int64()) for f in SPAN])))]
            return work
        results.append(make)
    if blocks == 1:
        return tx.annotate(docs, text, KIND, results[0])
    return _many_blocks(docs, text, results)


def characters(seen: tx.Words, d: int, a: int, z: int) -> tuple[int, int]:
    """Character bounds, in text ``d``, of words a to z - 1."""
    base, first = int(seen.offsets[d]), int(seen.first[d])
    begin, stop = int(seen.start[first + a]), int(seen.end[first + z - 1])
    lead = lambda lo, hi: int(np.count_nonzero((seen.bytes[lo:hi] & 0xC0) != 0x80))
    at = lead(base, begin)
    return at, at + lead(begin, stop)


def _many_blocks(docs, text, makes):
    """One scan per block; a document's spans are merged by its row number.
    The numbered rows are written, since each scan must find the same numbers."""
    row = tx.fresh("_row", docs.columns)
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), name="leak-rows")
    parts = None
    for make in makes:
        found, name = tx.annotate(keyed.select(row, text), text, KIND, make)
        found = found.select(row, F.col(name).alias("_f"))
        parts = found if parts is None else parts.unionByName(found)
    total = parts.groupBy(row).agg(F.max("_f.n_words").alias("n_words"),
                                   F.array_sort(F.array_distinct(F.flatten(F.collect_list("_f.items")))).alias("items"),
                                   F.array_sort(F.flatten(F.collect_list("_f.spans"))).alias("raw"))
    joint = F.aggregate("raw", F.slice("raw", 1, 0), _join_span)
    out = tx.fresh("_found", docs.columns)
    total = (total.withColumn("spans", joint)
             .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"]))
             .select(row, F.struct("n_words", "n_hit", "items", "spans").alias(out)))
    return keyed.join(total, row, "left").drop(row), out


def _join_span(done, span):
    last = F.try_element_at(done, F.lit(-1))
    longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"),
                      last["char_start"].alias("char_start"), F.greatest(last["char_end"], span["char_end"]).alias("char_end"))
    return F.when((F.size(done) > 0) & (last["end"] >= span["start"]),
                  F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(
                      F.concat(done, F.array(span)))


def digest(found: DataFrame, name: str, doc_id: str = "doc_id") -> DataFrame:
    """The per-document report: counts, items and their digest."""
    f = F.col(name)
    return found.select(F.col(doc_id), f["n_words"].alias("n_words"), f["n_hit"].alias("n_hit"),
                        F.size(f["items"]).cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(f["items"], ","), 256).alias("items_sha256"),
                        (f["n_hit"] > 0).alias("contaminated"))


def clean(found: DataFrame, name: str, text: str = "text", mode: str = "documents") -> DataFrame:
    """``documents``: drops each document with a verified hit.  ``spans``: cuts
    the hit characters out of the text and keeps the document."""
    if mode == "documents":
        return found.where(F.coalesce(F.col(name)["n_hit"], F.lit(0)) == 0).drop(name)
    if mode != "spans":
        raise ValueError(f"mode is documents or spans, not {mode}")
    spans = F.col(name)["spans"]
    bound = F.length(F.col(text))
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["char_end"]))
    stops = F.concat(F.transform(spans, lambda s: s["char_start"]), F.array(bound.cast("bigint")))
    kept = F.array_join(F.zip_with(starts, stops, lambda a, z: F.substring(F.col(text), (a + 1).cast("int"), (z - a).cast("int"))), "")
    return found.withColumn(text, F.when(F.size(spans) > 0, kept).otherwise(F.col(text))).drop(name)
