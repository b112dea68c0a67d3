"""Whitening by Golub-Kahan-Lanczos bidiagonalisation.

X holds the centred rows, one for each distinct integer vector.  A step takes
u = Xv and then z = X'u, orthogonalises both against all earlier ones, and so
finds orthonormal U and V with XV = UB for a small upper bidiagonal B, whose
singular values and vectors give the components and their deviations.

The long vectors u never exist as a table: as XV = UR with a small upper
triangular R (B and what the reorthogonalisation took off), a row's entries of
U are its entries of XW, W = V R^-1, so each step is one pass over the written
rows with matrices of the size of the dimensions, and a lost task reads its
rows again.  Orthogonalising u takes two sweeps: the first one's coefficients
U'(Xv) = (X'U)'v are known from earlier steps, the second one's are summed in
the same pass as X'u.  The driver holds matrices of dimensions x dimensions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.session import materialize

COMPONENTS = 16
#: Entries become floor(STEPS * c) + OFFSET, held within +-LARGEST.
STEPS, OFFSET, LARGEST = 64, 1_000_000, 1 << 52
#: Singular values and residuals below this share of the largest are zero.
TINY = 1e-11


def integers(vector: Column) -> Column:
    """Entries as longs: floor(64 c) + 1000000."""
    def one(c):
        return F.floor(F.greatest(F.least(c.cast("double") * STEPS, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))) + OFFSET
    return F.transform(vector, one)


def whole(vector: Column) -> Column:
    """Vectors that take part: not null or empty, all entries finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def _matrix(batch, column: str, dims: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class Centre:
    """Number of fitted rows, sums per dimension, and exact centring: the whole
    part of the mean is taken off in integers, the rest in double."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.dims = n, len(sums)
        self.base = np.array([s // n for s in sums], np.int64)
        self.part = np.array([s % n / n for s in sums])
        self.rest = np.array([s % n for s in sums], np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.part

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exactly; None where it leaves a long's range."""
        y = x - self.base  # n x - S = n y - rest
        most = int(np.abs(y).max(initial=0)) * self.n + self.n
        if self.dims * most * most < 1 << 63:
            y = self.n * y - self.rest
            return (y * y).sum(axis=1).tolist()
        exact = [sum((self.n * a - r) ** 2 for a, r in zip(row, self.rest.tolist())) for row in y.tolist()]
        return [d if d < 1 << 63 else None for d in exact]


def fit_rows(spark: SparkSession, vectors: DataFrame, x: str) -> tuple[DataFrame, Centre | None]:
    """The distinct vectors, written once, and their sums; of vectors of several
    lengths, those of the most frequent one (the smaller of equals) fit."""
    top = vectors.groupBy(F.size(x).alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if top is None:
        return vectors.select(F.col(x).alias("x")), None
    fit = materialize(vectors.where(F.size(x) == top["dims"]).select(F.col(x).alias("x")).distinct(), spark, "whitening-fit")
    wide = [F.sum(F.col("x")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(top["dims"])]
    total = fit.agg(F.count("*").alias("n"), *wide).first()
    return fit, Centre(total["n"], [int(s) for s in total[1:]])


def summed(fit: DataFrame, centre: Centre, f) -> np.ndarray:
    """Sum over all rows of ``f(centred rows) -> 1-d array``: one array a task,
    added up by an aggregate over its positions."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = f(centre.rows(_matrix(batch, "x", centre.dims)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["k", "value"])

    parts = fit.mapInArrow(run, tx.struct_type(k=T.IntegerType(), value=T.DoubleType()))
    rows = parts.groupBy("k").agg(F.sum("value").alias("value")).collect()  # one number a position
    return np.array([r["value"] for r in sorted(rows, key=lambda r: r["k"])])


def _step(v: np.ndarray, w: np.ndarray, known: np.ndarray):
    """One pass: p = Xv - U known, then U'p, p'p and X'p."""
    def f(x):
        u = x @ w
        p = x @ v - u @ known
        return np.concatenate([u.T @ p, [p @ p], x.T @ p])
    return f


def _orthogonal(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = x - basis @ (basis.T @ x)
    return x


def bidiagonalise(fit: DataFrame, centre: Centre, steps: int | None = None, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(V, B).  All steps are taken unless fewer are asked for, so equal
    singular values are found as often as they occur; where a Krylov space ends
    early, a new direction orthogonal to it goes on."""
    d = centre.dims
    steps = min(steps or d, d)
    rng = np.random.default_rng(seed)
    V, W, Z = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    B = np.zeros((steps, steps))
    v, beta, largest = rng.standard_normal(d), 0.0, 0.0
    v /= np.linalg.norm(v)
    for j in range(steps):
        known = Z.T @ v
        out = summed(fit, centre, _step(v, W, known))
        again, square, back = out[:j], out[j], out[j + 1:]
        alpha = float(np.sqrt(max(0.0, square - again @ again)))
        largest = max(largest, alpha, beta)
        if j:
            B[j - 1, j] = beta
        if alpha > TINY * largest:
            B[j, j] = alpha
            w, z = (v - W @ (known + again)) / alpha, (back - Z @ again) / alpha
        else:  # Xv lies in the span of U already
            w, z = np.zeros(d), np.zeros(d)
        V, W, Z = np.column_stack([V, v]), np.column_stack([W, w]), np.column_stack([Z, z])
        if j + 1 == steps:
            break
        r = _orthogonal(z, V)
        beta = float(np.linalg.norm(r))
        if beta <= TINY * max(largest, 1e-300):
            beta, r = 0.0, _orthogonal(rng.standard_normal(d), V)
        v = r / np.linalg.norm(r)
    return V, B


class Whitener:
    """Components (columns), eigenvalues and shares of the trace."""

    def __init__(self, centre: Centre, components: np.ndarray, values: np.ndarray, trace: float):
        self.centre, self.components, self.values, self.explained = centre, components, values, values / trace
        self.error = 0.0

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ self.components / np.sqrt(self.values)


def fit(rows: DataFrame, centre: Centre, most: int = COMPONENTS, steps: int | None = None) -> Whitener | None:
    """The leading components; None where all rows are equal."""
    trace = float(summed(rows, centre, lambda x: np.array([(x * x).sum()]))[0]) / centre.n
    if not trace > 0:
        return None
    V, B = bidiagonalise(rows, centre, steps)
    _, sigma, right = np.linalg.svd(B)
    keep = int((sigma > 1e-7 * sigma[0]).sum())  # eigenvalues below 1e-14 of the largest are rounding
    keep = min(most, keep)
    parts = V @ right[:keep].T
    parts *= np.sign(parts[np.abs(parts).argmax(axis=0), np.arange(keep)])  # sign: the largest entry is positive
    found = Whitener(centre, parts, sigma[:keep] ** 2 / centre.n, trace)

    def moments(x):
        y = x @ parts / np.sqrt(found.values)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    sums = summed(rows, centre, moments) / centre.n
    mean, square = sums[:keep], sums[keep:].reshape(keep, keep)
    found.error = float(np.abs(square - np.outer(mean, mean) - np.eye(keep)).max())
    return found


RESULT = tx.struct_type(component=T.IntegerType(), n=T.LongType(), deviation=T.LongType(), whitened=T.DoubleType(),
                        explained=T.DoubleType(), identity_error=T.DoubleType())


def whiten(vectors: DataFrame, most: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)
    for each usable row and each of up to ``most`` components.

    Rows whose vector is null, empty or holds null or non-finite entries are
    dropped, and so are vectors of another length than the most frequent one.
    Null ids and repeated rows are returned as they come; the fit takes each
    distinct vector once.  Of equal eigenvalues any orthonormal basis may come.
    There are fewer components where the distinct vectors span fewer dimensions,
    and no rows where none differ (or none are there).  A deviation beyond a
    long's range is null.  Entries beyond +-2^52 / 64 are held there.
    """
    spark = vectors.sparkSession
    used = vectors.where(whole(F.col(embedding))).select(F.col(vec_id).alias("vec_id"), integers(F.col(embedding)).alias("x"))
    rows, centre = fit_rows(spark, used, "x")
    found = fit(rows, centre, most) if centre else None
    kind = T.StructType([used.schema["vec_id"], *RESULT.fields])
    if found is None:
        return spark.createDataFrame([], kind)

    def run(batches):
        k = len(found.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, n = _matrix(batch, "x", centre.dims), batch.num_rows
            row = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                pa.array(np.full(n * k, centre.n)), pa.array(centre.deviation(x), pa.int64()).take(row),
                pa.array(found.apply(x).ravel()), pa.array(np.tile(found.explained, n)), pa.array(np.full(n * k, found.error))],
                names=kind.fieldNames())

    return used.where(F.size("x") == centre.dims).mapInArrow(run, kind)
