"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

A vector x is scaled to length one, u = x / |x|, and rounded to s * q with int8
entries q and a scale s of its own; e = |u - s * q| is its quantisation error.
By Cauchy-Schwarz the cosine of two vectors differs from s_a * s_b * (q_a . q_b)
by at most e_a + |s_a * q_a| * e_b.  Integer products of tiles of codes give the
middle term exactly; only pairs that the bound leaves possibly above the
threshold are computed again in double precision.

Equal vectors of a label are one representative with a count, so copies meet
nobody.  The representatives of a label are dealt by hash into chunks of a fixed
number of bytes, and each pair of chunks is one task's work: a hot label becomes
many tasks, and a task holds two chunks whatever the label's size.  No pairs
leave a task: only each vector's number of links and a spanning forest do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.llm.components import components
from salescast.session import materialize

THRESHOLD = 0.98
#: Bytes of the doubles of one chunk of vectors, and vectors on a side of a tile.
CHUNK_BYTES, TILE = 8 << 20, 1024
#: Covers the rounding of the bounds themselves, which are sums of doubles near 1.
SLACK = 1e-9
#: Dimensions whose int8 products sum up exactly in single precision (127 * 127 * n < 2^24).
EXACT = 1040

LINKS = tx.struct_type(rep=T.LongType(), links=T.LongType(), to=T.LongType())


def usable(label: Column, vector: Column) -> Column:
    """Rows that can link: a label, and finite entries that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by powers of two first, so that no square over- or underflows."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, lengths of the rounded vectors and errors, for unit rows."""
    scale = np.abs(u).max(axis=1) / 127
    code = np.rint(u / scale[:, None]).astype(np.int8)
    back = code * scale[:, None]
    return code, scale, np.sqrt((back * back).sum(axis=1)), np.sqrt(((u - back) ** 2).sum(axis=1))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _quantised(batches):
    for batch in batches:
        dims = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
        for d in np.unique(dims):
            part = batch.filter(pa.array(dims == d))
            code, scale, length, error = quantise(unit(_matrix(part.column("v"))))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale), pa.array(length), pa.array(error)],
                names=[*part.schema.names, "code", "scale", "length", "error"])


class Forest:
    """Union of linked vectors, all pairs of a block at once."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def possible(product: np.ndarray, a: slice, b: slice, scale, length, error, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile whose cosine may reach the threshold.  One comparison a
    pair against the loosest bound of the tile's columns, then their own bounds."""
    need = threshold - SLACK - error[a] - length[a] * error[b].max()
    by = scale[a] * np.where(need >= 0, scale[b].max(), scale[b].min())
    floor = np.nextafter((need / by).astype(np.float32), np.float32(-np.inf))
    i, j = np.nonzero(product >= floor[:, None])
    ia, jb = i + a.start, j + b.start
    sure = product[i, j] * scale[ia] * scale[jb] >= threshold - SLACK - error[ia] - length[ia] * error[jb]
    return ia[sure], jb[sure]


def cosines(u: np.ndarray, i: np.ndarray, j: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """Double-precision products of pairs of unit rows: pair by pair, or where
    the pairs fill much of their rows and columns, as one product of those."""
    rows, at = np.unique(i, return_inverse=True)
    cols, to = np.unique(j, return_inverse=True)
    if len(i) * 16 > len(rows) * len(cols):
        return (u[rows] @ u[cols].T)[at, to]
    return np.concatenate([np.einsum("ij,ij->i", u[i[k: k + block]], u[j[k: k + block]]) for k in range(0, len(i), block)])


def linked(rep, weight, second, vectors, code, scale, length, error, threshold: float, tile: int = TILE):
    """(rep, links, root) of the vectors that have links between a first and a
    ``second`` chunk, or inside one chunk where ``second`` is None: links counts
    the rows behind the linked vectors, root is a vector of the same component."""
    inside = second is None
    order = np.argsort(scale) if inside else np.lexsort((scale, second))  # like scales together: tight bounds of tiles
    rep, weight, code = rep[order], weight[order], code[order].astype(np.float32)
    scale, length, error, u = scale[order], length[order], error[order], unit(vectors[order])
    n = len(rep)
    cut = n if inside else n - int(second.sum())
    links, forest = np.zeros(n, np.int64), Forest(n)
    for x in range(0, cut, tile):
        a = slice(x, min(x + tile, cut))
        for y in range(x if inside else cut, n, tile):
            b = slice(y, min(y + tile, n))
            product = sum(code[a, k: k + EXACT] @ code[b, k: k + EXACT].T if code.shape[1] <= EXACT
                          else (code[a, k: k + EXACT] @ code[b, k: k + EXACT].T).astype(np.float64)
                          for k in range(0, code.shape[1], EXACT))
            i, j = possible(product, a, b, scale, length, error, threshold)
            if x == y:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            near = cosines(u, i, j) >= threshold
            i, j = i[near], j[near]
            links += np.bincount(i, weight[j], n).astype(np.int64) + np.bincount(j, weight[i], n).astype(np.int64)
            forest.join(i, j)
    has = links > 0
    return rep[has], links[has], rep[forest.root[has]]


def _pair_task(threshold: float, tile: int):
    def run(key, table):
        column = {c: table.column(c).combine_chunks() for c in table.column_names}
        number = {c: column[c].to_numpy(zero_copy_only=False) for c in ("rep", "weight", "chunk", "scale", "length", "error")}
        vectors = _matrix(column["v"])
        code = np.frombuffer(b"".join(column["code"].to_pylist()), np.int8).reshape(vectors.shape)
        first, last = key[2].as_py(), key[3].as_py()
        second = None if first == last else number["chunk"] == last
        found = linked(number["rep"], number["weight"], second, vectors, code, number["scale"], number["length"],
                       number["error"], threshold, tile)
        return pa.table([pa.array(x, pa.int64()) for x in found], names=LINKS.fieldNames())
    return run


def near(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
         chunk_bytes: int = CHUNK_BYTES, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``.

    Rows of one label link where the cosine of their vectors in double precision
    is at least ``threshold``; only vectors of the same length are compared.
    Rows without a label and vectors that are null, empty, zero or hold null or
    non-finite entries link with nothing and are their own component.  Repeated
    rows and equal vectors are rows of their own that link with each other.
    component_id is the smallest id of the component (null if none of its rows
    has one); kept is true for rows whose id that is, so rows that repeat the
    smallest id are all kept, and a component without ids keeps all its rows.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("v"))
    rows = rows.withColumn("ok", usable(F.col("label"), F.col("v")))
    distinct = rows.where("ok").groupBy("label", "v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    reps = distinct.select(F.monotonically_increasing_id().alias("rep"), "label", "v", "weight", "least")
    kind = T.StructType([*reps.schema.fields, *tx.struct_type(code=T.BinaryType(), scale=T.DoubleType(), length=T.DoubleType(),
                                                              error=T.DoubleType()).fields])
    reps = materialize(reps.mapInArrow(_quantised, kind), name="tiles-codes").withColumn("dim", F.size("v"))
    many = reps.groupBy("label", "dim").agg(F.ceil(F.count("*") * F.col("dim") * 8 / chunk_bytes).alias("chunks"))
    dealt = (reps.join(many, ["label", "dim"]).withColumn("chunk", F.pmod(F.xxhash64("rep"), "chunks"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))))
    pairs = dealt.groupBy("label", "dim", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"))
    found = materialize(pairs.applyInArrow(_pair_task(threshold, tile), LINKS), name="tiles-links")
    root = components(found.select(F.col("rep").alias("src"), F.col("to").alias("dst")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    owner = (reps.select("rep", "label", "v", "weight", "least").join(links, "rep", "left")
             .join(root.withColumnRenamed("node", "rep"), "rep", "left")
             .select("label", "v", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("root", "rep").alias("root")))
    owner = materialize(owner, name="tiles-owner")
    smallest = owner.groupBy("root").agg(F.min("least").alias("component_id"))
    of = owner.join(smallest, "root").select("label", "v", "n_links", "component_id")
    linking = rows.where("ok").join(of, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linking.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
