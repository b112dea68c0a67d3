"""SimHash near-duplicates by pivot distance tables.

Each distinct fingerprint has a row of Hamming distances to many reference
fingerprints (the pivots).  Two fingerprints within r bits differ by at most r
in every coordinate, so a pair whose largest coordinate difference is above r
is discarded from the table alone; survivors are verified on the bits.

Pairs come from keys of two equal blocks out of r + 2 (r differing bits leave
at least two blocks untouched).  A key shared by more than ``most`` distinct
fingerprints is not paired: its members go through an exact linear form, in
which two fingerprints within 2 bits meet at a fingerprint one bit from both.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.llm.components import components
from salescast.session import materialize

#: Words in a shingle, most differing bits, and seed of the shingle hash.
SHINGLE, RADIUS, SEED = 3, 2, 42
PIVOTS = 16
#: Distinct fingerprints of one key that are paired with each other.
PAIRED = 64


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> bytes:
    """Big-endian SimHash of a text's shingles; zero without words."""
    ws = text.lower().split()  # bytes: A-Z only, and the six ASCII white spaces
    if not ws:
        return bytes(8)
    joined = b" ".join(ws)
    ends = list(accumulate(len(w) + 1 for w in ws))
    starts = [0, *ends[:-1]]
    h = xxhash.xxh64_digest
    stop = ends[min(shingle, len(ws)) - 1:]
    all_h = b"".join([h(joined[a:z - 1], SEED) for a, z in zip(starts, stop)])
    ones = np.unpackbits(np.frombuffer(all_h, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(stop)).tobytes()


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> tuple[DataFrame, str]:
    """``docs`` with a struct column holding ``fp``, the 64 bits as a long."""

    def make():
        def work(piece, at):
            fps = b"".join(fingerprint_of(t.encode() if t else b"", shingle) for t in piece.column(at).to_pylist())
            return [pa.array(np.frombuffer(fps, ">i8").astype(np.int64))]
        return work

    return tx.annotate(docs, text, tx.struct_type(fp=T.LongType()), make, "_simhash")


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: the signed 64 bits of XXH64 of their numbers."""
    return [int(np.uint64(xxhash.xxh64_intdigest(str(k).encode(), SEED)).astype(np.int64)) for k in range(n)]


def pivot_table(fps: DataFrame, n: int = PIVOTS) -> DataFrame:
    """``fp`` with ``d``, its distances to the pivots, one byte each."""
    return fps.withColumn("d", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("byte") for p in pivots(n)]))


def block_keys(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 2 blocks that cover the 64 bits."""
    n = radius + 2
    edges = [64 * k // n for k in range(n + 1)]
    return [(a, z - a) for a, z in zip(edges, edges[1:])]


def links(fps: DataFrame, radius: int = RADIUS, n_pivots: int = PIVOTS, most: int = PAIRED) -> DataFrame:
    """Edges (src, dst) between distinct fingerprints, ``fps`` holding each
    once, that connect exactly those within ``radius`` bits: pairs for all keys
    of up to ``most`` fingerprints, and stars around shared neighbours for the
    members of fuller keys."""
    if not 1 <= radius <= 2:
        raise ValueError("radius is 1 or 2")
    table = pivot_table(fps, n_pivots)
    blocks = block_keys(radius)
    part = [F.shiftrightunsigned(F.col("fp"), a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in blocks]
    keys = F.array(*[F.struct(F.lit(k).cast("byte").alias("which"), F.shiftleft(part[i], blocks[j][1]).bitwiseOR(part[j]).alias("bits"))
                     for k, (i, j) in enumerate(combinations(range(len(blocks)), 2))])
    keyed = table.select("fp", "d", F.explode(keys).alias("key")).select("fp", "d", "key.which", "key.bits")
    shared = keyed.groupBy("which", "bits").agg(F.count("*").alias("n")).where("n > 1")
    rows = materialize(keyed.join(shared, ["which", "bits"]), name="simhash-keys")
    cold = rows.where(F.col("n") <= most)
    near = F.forall(F.zip_with("l.d", "r.d", lambda a, b: F.abs(a.cast("int") - b.cast("int"))), lambda x: x <= radius)
    pairs = (cold.alias("l").join(cold.alias("r"), (F.col("l.which") == F.col("r.which")) & (F.col("l.bits") == F.col("r.bits"))
                                  & (F.col("l.fp") < F.col("r.fp")) & near)
             .select(F.col("l.fp").alias("src"), F.col("r.fp").alias("dst"))
             .where(F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= radius))
    hot = rows.where(F.col("n") > most).select("fp", "d").distinct()
    return pairs.unionByName(stars(hot, radius)).distinct()


def stars(fps: DataFrame, radius: int) -> DataFrame:
    """Fingerprints within 2 bits share a neighbour at one bit (or are at one
    bit themselves).  Each of the at most 65 members around a centre is linked
    to the smallest one that is within ``radius``; rows grow with the members."""
    centres = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(int(np.uint64(1 << b).astype(np.int64)))) for b in range(64)])
    groups = (fps.select("fp", F.explode(centres).alias("centre")).groupBy("centre")
              .agg(F.array_sort(F.collect_list("fp")).alias("all")).where(F.size("all") > 1))
    if radius == 2:  # all members of a ball are within 2 bits of each other
        edges = groups.select(F.col("all")[0].alias("src"), F.explode(F.slice("all", 2, 64)).alias("dst"))
    else:
        edges = groups.select(F.col("centre").alias("src"), F.explode("all").alias("dst"))
        edges = edges.join(fps.select(F.col("fp").alias("src")), "src", "left_semi").select("src", "dst")
    return edges.where((F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= radius) & (F.col("src") != F.col("dst")))


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int, n_pivots: int, most: int,
             also=()) -> tuple[DataFrame, DataFrame]:
    """Written tables: (doc_id, fp) and the columns ``also`` of each row, and
    (fp, least, root), the component of each distinct fingerprint."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *also)
    fp, name = fingerprints(rows, "text", shingle)
    fp = materialize(fp.select("doc_id", F.col(name)["fp"].alias("fp"), *rows.columns[2:]), name="simhash-fp")
    distinct = fp.groupBy("fp").agg(F.min("doc_id").alias("least"))
    edges = links(distinct.select("fp"), radius, n_pivots, most)
    label = components(edges)  # fp -> smallest fp of the component, where linked
    owner = distinct.join(label, distinct["fp"] == label["node"], "left")
    return fp, materialize(owner.select(distinct["fp"], "least", F.coalesce("root", distinct["fp"]).alias("root")), name="simhash-owner")


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
            radius: int = RADIUS, n_pivots: int = PIVOTS, most: int = PAIRED) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    component_id is the smallest id reachable over links of at most ``radius``
    bits.  Texts that are null, empty or blank have fingerprint zero, which is
    linked like any other.  Rows with a null id take part with their text and
    get their component's smallest id (null if it has none); repeated rows are
    returned as often as they come.  Copies share one fingerprint, which is
    looked up once.
    """
    fp, owner = _grouped(docs, doc_id, text, shingle, radius, n_pivots, most)
    smallest = owner.groupBy("root").agg(F.min("least").alias("component_id"))
    of = owner.join(smallest, "root").select("fp", "component_id")
    return fp.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS, n_pivots: int = PIVOTS, most: int = PAIRED) -> DataFrame:
    """One row of each component of near-duplicates, whatever ids its rows have:
    the one with the smallest id (null last), then the longest text, then the
    smallest digest of it.  Of rows alike in id and text any one stays; null
    reads as empty.  Rows that share an id and not a component are each kept.
    """
    taken = docs.columns
    digest, key, body = tx.fresh("_digest", taken), tx.fresh("_id", taken), F.coalesce(F.col(text), F.lit(""))
    also = [F.sha2(body.cast("binary"), 256).alias("_digest"), F.length(body).alias("_size")]
    fp, owner = _grouped(docs, doc_id, text, shingle, radius, n_pivots, most, also)
    each = fp.groupBy("fp", "doc_id", "_digest").agg(F.count("*").alias("rows"), F.max("_size").alias("size"))
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), (-F.col("size")).alias("c"), F.col("_digest").alias("d"), "rows")
    best = each.join(owner.select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("m"))
    best = materialize(best.select(F.col("m.b").alias(key), F.col("m.d").alias(digest), F.col("m.rows").alias("_rows")), name="simhash-best")
    marked = docs.withColumn(digest, F.sha2(body.cast("binary"), 256))

    def of(chosen):
        chosen = chosen.drop("_rows").alias("r")
        same = F.col(f"l.`{doc_id}`").eqNullSafe(F.col(f"r.`{key}`")) & (F.col(f"l.`{digest}`") == F.col(f"r.`{digest}`"))
        return marked.alias("l").join(chosen, same, "left_semi")

    repeated = of(best.where("_rows > 1")).dropDuplicates([doc_id, digest])
    return of(best.where("_rows = 1")).unionByName(repeated).select(*[F.col(f"`{c}`") for c in taken])
