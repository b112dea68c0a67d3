"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents marked good; everything else is unlabelled
web text.  A logistic model over statistics of the text minimises the
non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the class prior estimated from the two samples alone: a first model tells
positives from unlabelled text, and the prior is the least ratio, over score
thresholds, of unlabelled to positive documents above it (with the usual bound
on the sampling error choosing the threshold).

Both models are fitted by Newton steps.  Each step is one Spark job over the
feature table of all documents, which returns sums (a gradient and a Hessian of
about 20 features); no rows reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.session import materialize

THRESHOLD = 0.3
RIDGE, STEPS, TOLERANCE = 1e-3, 12, 1e-5
#: Newton step lengths that one job tries.
LENGTHS = (1.0, 0.5, 0.2, 0.05)
BINS = 1000

IS_SPACED = np.ones(256, bool)
IS_SPACED[[32, 9, 10, 11, 12, 13]] = False


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars.encode())] = 1
    return table


#: Byte classes whose share of a text is a feature.
CLASSES = {
    "symbol": _class("#*$%&<>@~^=+\\{}[]"),
    "bar": _class("|"),
    "bang": _class("!?"),
    "upper": _class(tx.ASCII_UPPER),
    "digit": _class("0123456789"),
    "stop": _class(".,;:"),
    "line": _class("\n"),
    "beyond": (np.arange(256) >= 128).astype(np.uint8),
}
RATIOS = [*CLASSES, "adjacent", "repeated"]
FEATURES = ["one", *RATIOS, *[f"root_{r}" for r in RATIOS], "log_words", "word_length"]


def featurize(column) -> np.ndarray:
    """(texts, FEATURES): shares of byte classes, of words that repeat their
    left neighbour and of words seen before, their roots, and two lengths."""
    raw, offsets = tx.utf8(column)
    seen = tx.Words(column, IS_SPACED)
    n_docs = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    ratio = {}
    for name, table in CLASSES.items():
        total = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
        ratio[name] = np.diff(total[offsets]) / size
    count = seen.counts()
    doc, h = seen.doc(), seen.hashes()
    safe = np.maximum(count, 1)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    ratio["adjacent"] = np.bincount(doc[again], minlength=n_docs) / safe
    order = np.lexsort((h, doc))
    first = np.ones(len(h), bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    ratio["repeated"] = np.where(count > 0, 1 - np.bincount(doc[order][first], minlength=n_docs) / safe, 0.0)
    cols = [np.ones(n_docs), *[ratio[r] for r in RATIOS], *[np.sqrt(ratio[r]) for r in RATIOS], np.log1p(count), np.diff(offsets) / safe / 10]
    return np.minimum(np.stack(cols, axis=1), 20.0)


def features(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    def make():
        def work(piece, at):
            x = featurize(piece.column(at))
            return [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))]
        return work
    return tx.annotate(docs, text, tx.struct_type(x=T.ArrayType(T.DoubleType())), make, "_quality")


def _summed(rows: DataFrame, part) -> np.ndarray:
    """Sum over tasks of the vector that ``part`` makes of a (x, positive)
    batch; tasks' vectors are added by Spark, position by position."""

    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                x = b.column(0).values.to_numpy(zero_copy_only=False) if b.column(0).offset == 0 else np.concatenate(b.column(0).to_pylist())
                got = part(x.reshape(b.num_rows, -1), b.column(1).to_numpy(zero_copy_only=False).astype(bool))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["i", "v"])

    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", T.DoubleType())])
    out = rows.select("x", "positive").mapInArrow(run, schema).groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    order = np.argsort(out.column("i").to_numpy())
    return out.column("v").to_numpy()[order]


@dataclass
class Model:
    weights: list
    mean: list
    scale: list
    prior: float

    def column(self, x: Column) -> Column:
        """Probability of the good class, as a Spark expression."""
        z = sum((F.get(x, i) - m) / s * w for i, (w, m, s) in enumerate(zip(self.weights, self.mean, self.scale)))
        return 1 / (1 + F.exp(-z))


def _loss(z):
    return np.logaddexp(0, -z)


def newton(rows: DataFrame, mean, scale, n_pos: float, n_un: float, prior: float | None) -> np.ndarray:
    """Weights that minimise the non-negative risk for ``prior``, or with None
    the logistic loss of positives against unlabelled text."""
    d = len(mean)
    w, step = np.zeros(d), np.zeros(d)
    best = math.inf
    for _ in range(STEPS):
        tried = [w + t * step for t in (LENGTHS if step.any() else (0.0,))]

        def part(x, positive, tried=tried):
            x = (x - mean) / scale
            out = []
            for v in tried:
                z = x @ v
                p, u = x[positive], x
                s_p, s_u = 1 / (1 + np.exp(-np.clip(z[positive], -60, 60))), 1 / (1 + np.exp(-np.clip(z, -60, 60)))
                h_p, h_u = s_p * (1 - s_p), s_u * (1 - s_u)
                out += [[_loss(z[positive]).sum(), _loss(-z[positive]).sum(), _loss(-z).sum()], p.sum(0), ((1 - s_p)[:, None] * p).sum(0),
                        (s_u[:, None] * u).sum(0), (p * h_p[:, None]).T @ p, (u * h_u[:, None]).T @ u]
            return np.concatenate([np.ravel(o) for o in out])

        got = _summed(rows, part).reshape(len(tried), -1)
        results = []
        for v, g in zip(tried, got):
            plus, minus_p, minus_u = g[0] / n_pos, g[1] / n_pos, g[2] / n_un
            rest = minus_u - (prior or 0) * minus_p
            share = n_pos / (n_pos + n_un)
            risk = share * plus + (1 - share) * minus_u if prior is None else prior * plus + max(0.0, rest)
            results.append((risk + RIDGE / 2 * v @ v, rest, v, g))
        now, rest, v, g = min(results, key=lambda r: r[0])
        if now > best - TOLERANCE * max(1, abs(best)) and math.isfinite(best):
            return v if now < best else w
        best, w = now, v
        x_p, miss_p, hit_u = (g[3 + k * d: 3 + (k + 1) * d] for k in range(3))
        hess_p, hess_u = (g[3 + 3 * d + k * d * d: 3 + 3 * d + (k + 1) * d * d].reshape(d, d) for k in range(2))
        if prior is None:
            grad, hess = -share * miss_p / n_pos + (1 - share) * hit_u / n_un, share * hess_p / n_pos + (1 - share) * hess_u / n_un
        elif rest > 0:
            grad, hess = -prior * x_p / n_pos + hit_u / n_un, hess_u / n_un
        else:  # the clipped part is not minimised further
            grad, hess = -prior * miss_p / n_pos, prior * hess_p / n_pos
        step = -np.linalg.solve(hess + RIDGE * np.eye(d), grad + RIDGE * w)
    return w


def class_prior(rows: DataFrame, score: Column, n_pos: float, n_un: float) -> float:
    """Least ratio, over thresholds, of unlabelled to positive rows above it."""
    b = F.least(F.floor(score * BINS), F.lit(BINS - 1)).cast("int")
    got = rows.groupBy(b.alias("b")).agg(F.count("*").alias("u"), F.sum(F.col("positive").cast("int")).alias("p")).toArrow()
    u, p = np.zeros(BINS), np.zeros(BINS)
    at = got.column("b").to_numpy()
    u[at], p[at] = got.column("u").to_numpy(), got.column("p").to_numpy()
    above_u, above_p = np.cumsum(u[::-1]) / n_un, np.cumsum(p[::-1]) / n_pos
    slack = math.sqrt(math.log(4 / 0.1) / (2 * n_un)) + math.sqrt(math.log(4 / 0.1) / (2 * n_pos))
    ok = above_p > 0
    bound = (above_u[ok] + 1.01 * slack) / above_p[ok]
    k = int(np.argmin(bound))
    return float(np.clip((above_u[ok] / above_p[ok])[k], 0.01, 0.99))


def fit(rows: DataFrame) -> Model:
    """From (x, positive) rows; without positives everything scores the same."""
    sums = _summed(rows, lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(0), (x * x).sum(0)]))
    d = len(FEATURES)
    if not len(sums) or not sums[1]:
        return Model([0.0] * d, [0.0] * d, [1.0] * d, 0.5)
    n, n_pos = float(sums[0]), float(sums[1])
    mean = sums[2:2 + d] / n
    scale = np.sqrt(np.maximum(sums[2 + d:] / n - mean**2, 0))
    mean[0] = 0.0
    scale[0] = 1.0
    scale[scale < 1e-9] = 1.0
    first = Model(list(map(float, newton(rows, mean, scale, n_pos, n, None))), list(map(float, mean)), list(map(float, scale)), 0.5)
    prior = class_prior(rows, first.column(F.col("x")), n_pos, n)
    weights = newton(rows, mean, scale, n_pos, n, prior)
    return Model(list(map(float, weights)), first.mean, first.scale, prior)


def trusted(labels: DataFrame, train: Column) -> DataFrame:
    """Ids marked good and never bad, in the rows that may be learned from."""
    return (labels.where(F.coalesce(train, F.lit(False))).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
            .select(F.col("doc_id").alias("_good")))


def score(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Model]:
    """(doc_id, score) for each row, and the model.  ``train`` is a condition on
    the label's ``doc_id`` that says which labels may be learned from; texts of
    all rows are unlabelled text.

    A null text is empty, and empty texts are scored like any other; rows with
    a null id are unlabelled; repeated rows count as often as they come.
    """
    found, name = features(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    rows = found.select("doc_id", F.col(name)["x"].alias("x"))
    good = trusted(labels, train)
    rows = materialize(rows.join(good, rows["doc_id"] == good["_good"], "left")
                       .select("doc_id", "x", F.col("_good").isNotNull().alias("positive")), name="quality")
    model = fit(rows)
    return rows.select("doc_id", model.column(F.col("x")).alias("score")), model


def apply(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, Column]:
    """``docs`` with a struct column of features, and the score over it; nothing
    is shuffled."""
    found, name = features(docs, text)
    return found, model.column(F.col(name)["x"])
