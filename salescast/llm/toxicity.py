"""Toxicity by a support vector machine over a subsequence string kernel, with
Nystroem landmarks.

A text is read as sentences of units: white-space tokens without their
punctuation ("id-i.ot" gives "idiot"), and runs of single letters read as one
("i d i o t"); letters that repeat more than twice are cut to two, and a mark
stands before and after each unit.  The kernel of two
units is the sum over common subsequences of three and of four bytes with gaps,
and of six without, each occurrence weighted by ``DECAY`` to the power of the
stretch it covers, gaps included; it is divided by what a unit of that length
would give with itself.  So insults with gaps or inserted characters keep most
of their kernel value.

Landmarks are units; the Nystroem map K(landmarks)^(-1/2) k(., landmarks) is fed
to a linear support vector machine.  Its decision is a weighted sum of kernels
with the landmarks, which is the same as one weight for each subsequence, so
whole texts are scored by table look-ups over their bytes.  A sentence scores as
its most toxic unit and a document as its most toxic sentence; a logistic curve
over that and the number of units on the toxic side (up to ``HITS``), fitted to
all learnable labelled documents, turns it into a probability.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.llm.quality import IS_SPACED
from salescast.session import materialize

DECAY = 0.6
#: Offsets of the further bytes of a subsequence: three within five, four within six, six in a row.
PATTERNS = [*combinations(range(1, 5), 2), *combinations(range(1, 6), 3), (1, 2, 3, 4, 5)]
TABLE_BITS = 20
#: Landmarks of toxic units, of frequent clean ones, and of clean ones that scored highest.
LANDMARKS = (160, 48, 160)
#: Most labels that a fit uses (a sample by a hash of the id beyond that), which bounds their broadcast.
LABELLED = 1_000_000
#: Units of either class that the machine is fitted on, the most frequent ones.
FIT_POSITIVE, FIT_NEGATIVE = 600, 8_000
#: Suspected units, and toxic documents (the first by a hash of the text) in which they are told apart.
SUSPECTS, COVERED = 6_000, 20_000
#: Times that the clean units which score highest are added to the fit, and how many.
ROUNDS, FIT_HARD = 3, 3_000
#: Chance that any unit is taken for toxic by accident.
MISTAKE = 0.05
THRESHOLD = 0.5
COST = 10.0
HITS = 5
TASK_UNITS = 400_000

#: Byte -> 6-bit symbol: letters, digits, and the bytes beyond ASCII by rule; 0 is the mark.
SYMBOL = np.zeros(256, np.uint32)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[48:58] = np.arange(27, 37)
SYMBOL[128:] = 37 + np.arange(128) % 27


class Units:
    """Units of a piece: their plain bytes and bounds, and their texts."""

    def __init__(self, column):
        tokens = tx.Words(column, IS_SPACED)
        plain = np.flatnonzero(tx.IS_PLAIN[tokens.bytes])
        token = np.searchsorted(tokens.start, plain, "right") - 1
        first = np.searchsorted(plain, tokens.start)
        stop = np.searchsorted(plain, tokens.end)
        self.bytes, self.n_docs = tokens.bytes[plain], len(tokens.first) - 1
        used = stop > first
        self.start, self.end, self.doc = first[used], stop[used], tokens.doc()[used]
        # runs of three or more one-letter tokens of a text, joined
        lead = tokens.bytes[plain] & 0xC0 != 0x80
        chars = np.concatenate([[0], np.cumsum(lead)])
        single = (chars[self.end] - chars[self.start]) == 1
        joins = single[1:] & single[:-1] & (self.doc[1:] == self.doc[:-1])
        edge = np.flatnonzero(np.diff(np.concatenate([[False], joins, [False]]).astype(np.int8)))
        for a, z in zip(edge[::2], edge[1::2]):  # a run is contiguous in the plain bytes
            if z - a >= 2:
                self.end[a], self.start[a + 1: z + 1], self.end[a + 1: z + 1] = self.end[z], self.end[z], self.end[z]
        keep = self.end > self.start
        self.doc = self.doc[keep]
        self._shorten(np.repeat(np.arange(len(self.doc)), self.end[keep] - self.start[keep]))

    def _shorten(self, unit):
        """Cuts runs of one byte, or of one pair of bytes (a letter beyond
        ASCII), to two.  ``unit`` is the unit of each plain byte."""
        def again(k):
            same = np.zeros(len(unit), bool)
            same[k:] = (self.bytes[k:] == self.bytes[:-k]) & (unit[k:] == unit[:-k])
            return same

        def after(same, k):
            out = np.zeros(len(same), bool)
            out[k:] = same[:-k]
            return out
        one, two = again(1), again(2)
        kept = ~(one & after(one, 1)) & ~(two & after(two, 1) & after(two, 2) & after(two, 3))
        self.bytes = self.bytes[kept]
        length = np.bincount(unit[kept], minlength=len(self.doc))
        self.end = np.cumsum(length)
        self.start = self.end - length

    def text(self) -> list[bytes]:
        raw = self.bytes.tobytes()
        return [raw[a:z] for a, z in zip(self.start.tolist(), self.end.tolist())]


def occurrences(symbol: np.ndarray, unit: np.ndarray):
    """For each pattern: the feature number at each position, whether the
    pattern stays within a unit there, and its weight."""
    n, within = len(symbol), {}
    for k, p in enumerate(PATTERNS):
        reach = p[-1]
        if n <= reach:
            continue
        if reach not in within:
            within[reach] = unit[:-reach] == unit[reach:]
        code = symbol[:n - reach] + np.uint32(len(p) << 6)  # patterns of as many bytes share features
        for off in p:
            code = code * np.uint32(0x01000193)
            code += symbol[off: n - reach + off]
        code *= np.uint32(0x9E3779B1)
        code >>= np.uint32(32 - TABLE_BITS)
        yield code, within[reach], DECAY ** (reach + 1)


def norms(most: int) -> np.ndarray:
    """Root of the kernel of a unit of each length with itself, its
    subsequences taken as distinct."""
    total = np.zeros(most + 1)
    for p in PATTERNS:
        total += np.maximum(np.arange(most + 1) - p[-1], 0) * DECAY ** (2 * (p[-1] + 1))
    return np.sqrt(np.maximum(total, 1e-12))


def score_units(u: Units, weights: np.ndarray, bias: float) -> np.ndarray:
    """Decision of the machine for each unit."""
    symbol, unit, length = marked(u)
    total, used = np.zeros(len(length)), weights != 0
    for code, within, weight in occurrences(symbol, unit):
        at = np.flatnonzero(used[code] & within)
        total += weight * np.bincount(unit[at], weights[code[at]], minlength=len(length))
    return total / norms(int(length.max()) if len(length) else 0)[length] + bias


def marked(u) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all units with their marks, the unit of each, and lengths."""
    length = u.end - u.start
    full = length + 2
    symbol = np.zeros(int(full.sum()), np.uint32)
    symbol[_spread(np.cumsum(full) - full + 1, length)] = SYMBOL[u.bytes[_spread(u.start, length)]]
    return symbol, np.repeat(np.arange(len(length), dtype=np.int32), full), full


def _spread(start, length):
    """All positions start[i] .. start[i] + length[i] - 1."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


@dataclass
class Machine:
    weights: np.ndarray
    bias: float
    slope: float = 4.0
    more: float = 0.0
    shift: float = 0.0

    def probability(self, decision: Column, hits: Column) -> Column:
        return 1 / (1 + F.exp(-(decision * self.slope + F.log1p(F.least(hits, F.lit(HITS))) * self.more + self.shift)))


def _counted(batches):
    """Documents of each class that a unit occurs in, gathered within a task."""
    seen = (Counter(), Counter())

    def rows():
        units = list({*seen[0], *seen[1]})
        return pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in units], pa.string()),
                                           *[pa.array([c[w] for w in units], pa.int64()) for c in seen]], names=["unit", "clean", "toxic"])

    for batch in batches:
        for piece in tx.pieces(batch, "text"):
            u = Units(piece.column(0))
            texts, bounds = u.text(), np.searchsorted(u.doc, np.arange(piece.num_rows + 1))
            for d, y in enumerate(piece.column(1).to_pylist()):
                seen[y].update(set(texts[bounds[d]: bounds[d + 1]]))
            if len(seen[0]) + len(seen[1]) > TASK_UNITS:
                yield rows()
                seen = (Counter(), Counter())
    yield rows()


def units_of(docs: DataFrame, labelled: DataFrame) -> tuple[list[str], list[str], DataFrame]:
    """The toxic units, the most frequent units of clean documents, and the
    table of all clean units.

    Units that occur in toxic documents by far too often for chance are
    suspected.  Of these, the ones that explain toxic documents are kept: again
    and again the unit that is in most documents without one so far.  (The
    other words of a toxic document that was copied often explain none.)"""
    schema = T.StructType([T.StructField("unit", T.StringType()), T.StructField("clean", T.LongType()), T.StructField("toxic", T.LongType())])
    rows = docs.join(F.broadcast(labelled), "doc_id").select("text", "toxic")
    counts = materialize(rows.mapInArrow(_counted, schema).groupBy("unit").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
                         name="toxic-units")
    by = labelled.groupBy("toxic").agg(F.count("*").alias("n")).toArrow().to_pydict()
    n = dict(zip(by["toxic"], by["n"]))
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return [], [], counts.where("false").select("unit")
    kinds = max(1, counts.count())
    share = toxic / (toxic + clean)
    # log-likelihood gain of the unit's own share over the overall share
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    own = lambda x, p: F.when(x > 0, x * F.log(x / (t + c) / p)).otherwise(0.0)
    gain = own(t, share) + own(c, 1 - share)
    odd = (gain > float(np.log(kinds / MISTAKE))) & (t / toxic > 4 * c / clean) & (F.length("unit") > 2)
    suspects = [r.unit for r in counts.where(odd).orderBy(F.desc(gain), "unit").limit(SUSPECTS).collect()]
    usual = counts.where(~odd & (c > 0))
    negative = usual.orderBy(F.desc("clean"), "unit").limit(FIT_NEGATIVE)
    return explaining(rows.where("toxic = 1").select("text"), suspects), [r.unit for r in negative.collect()], usual.select("unit")


def explaining(toxic: DataFrame, suspects: list[str]) -> list[str]:
    """Suspects in the order in which they explain most further documents."""
    held = toxic.sparkSession.sparkContext.broadcast({s.encode(): i for i, s in enumerate(suspects)})

    def run(batches):
        number = held.value
        for batch in batches:
            for piece in tx.pieces(batch, "text"):
                u = Units(piece.column(0))
                texts, bounds = u.text(), np.searchsorted(u.doc, np.arange(piece.num_rows + 1))
                found = [sorted({number[w] for w in texts[a:z] if w in number}) for a, z in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(found, pa.list_(pa.int32()))], names=["h", "found"])

    # texts become lists of suspects where they are read; only lists are sorted and limited
    kind = T.StructType([T.StructField("h", T.LongType()), T.StructField("found", T.ArrayType(T.IntegerType()))])
    lists = toxic.select("text", F.xxhash64("text").alias("h")).mapInArrow(run, kind).where("size(found) > 0")
    docs = lists.orderBy("h", "found").limit(COVERED).toArrow().column("found").to_pylist()
    left, of = Counter(i for d in docs for i in d), {}
    for k, d in enumerate(docs):
        for i in d:
            of.setdefault(i, []).append(k)
    out, done = [], set()
    while left and len(out) < FIT_POSITIVE:
        best, n = min(left.items(), key=lambda kv: (-kv[1], kv[0]))
        if n < 1:
            break
        out.append(suspects[best])
        for k in of[best]:
            if k not in done:
                done.add(k)
                left.subtract(docs[k])
    return out


class _Column:
    """Units given as a list, in the shape that score_units reads."""

    def __init__(self, units: list[bytes]):
        self.bytes = np.frombuffer(b"".join(units), np.uint8)
        length = np.array([len(x) for x in units], np.int64)
        self.end = np.cumsum(length)
        self.start = self.end - length


def train(positive: list[str], negative: list[str], frequent: int | None = None) -> Machine:
    """Squared-hinge machine on the Nystroem features of the units; of the
    negative ones, those beyond the first ``frequent`` were hard to tell."""
    units = [x.encode() for x in [*positive, *negative]]
    empty = np.zeros(1 << TABLE_BITS)
    if not positive or not negative:
        return Machine(empty, -1.0)
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    symbol, unit, length = marked(_Column(units))
    scale = norms(int(length.max()))[length]
    found = [(unit[:len(code)][within], code[within], np.full(int(within.sum()), w)) for code, within, w in occurrences(symbol, unit)]
    row, code, value = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(row, kind="stable")
    row, code, value = row[order], code[order], value[order] / scale[row[order]]
    bounds = np.searchsorted(row, np.arange(len(units) + 1))

    def kernel(i):
        mine = slice(bounds[i], bounds[i + 1])
        dense = np.bincount(code[mine], value[mine], minlength=1 << TABLE_BITS)
        return np.bincount(row, value * dense[code], minlength=len(units))

    # landmarks: of each group in turn, the unit that those so far describe least
    chosen, columns = [], []
    cuts = [0, len(positive), len(positive) + (len(negative) if frequent is None else frequent), len(units)]
    for group, most in zip((np.arange(a, z) for a, z in zip(cuts, cuts[1:])), LANDMARKS):
        nearest = np.zeros(len(group))
        for _ in range(min(most, len(group))):
            i = int(group[int(np.argmin(nearest))]) if chosen else int(group[0])
            if i in chosen:
                break
            k = kernel(i)
            chosen.append(i), columns.append(k)
            nearest = np.maximum(nearest, k[group])
    k_nm = np.stack(columns, axis=1)
    k_mm = k_nm[chosen]
    value_m, vector_m = np.linalg.eigh((k_mm + k_mm.T) / 2)
    good = value_m > 1e-6 * value_m.max()
    root = vector_m[:, good] / np.sqrt(value_m[good]) @ vector_m[:, good].T
    phi = np.concatenate([k_nm @ root, np.ones((len(units), 1))], axis=1)
    # both classes weigh the same in the sum of squared hinges
    cost = np.where(y > 0, COST * len(negative) / len(positive), COST) / len(negative) * 100
    w = np.zeros(phi.shape[1])
    ridge = np.eye(phi.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        margin = 1 - y * (phi @ w)
        active = margin > 0
        a = phi[active] * cost[active][:, None]
        new = np.linalg.solve(ridge + a.T @ phi[active], a.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    weights = empty
    for i, a in zip(chosen, root @ w[:-1]):
        mine = slice(bounds[i], bounds[i + 1])
        np.add.at(weights, code[mine], a * value[mine])
    return Machine(weights, float(w[-1]))


def decisions(docs: DataFrame, machine: Machine, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column: the decision of the most toxic unit (the
    bias for a text without units), the unit, and the number of units above 0."""
    held = docs.sparkSession.sparkContext.broadcast((machine.weights, machine.bias))

    def make():
        weights, bias = held.value

        def work(piece, at):
            u = Units(piece.column(at))
            f = score_units(u, weights, bias)
            best = np.full(piece.num_rows, bias)
            np.maximum.at(best, u.doc, f)
            if len(f):
                order = np.lexsort((-f, u.doc))
                doc, lead = np.unique(u.doc[order], return_index=True)
                top = dict(zip(doc.tolist(), order[lead].tolist()))
            else:
                top = {}
            said = [bytes(u.bytes[u.start[top[d]]: u.end[top[d]]]).decode("utf-8", "replace") if d in top else None for d in range(piece.num_rows)]
            return [pa.array(best), pa.array(said, pa.string()), pa.array(np.bincount(u.doc[f > 0], minlength=piece.num_rows))]
        return work

    return tx.annotate(docs, text, tx.struct_type(decision=T.DoubleType(), unit=T.StringType(), hits=T.LongType()), make, "_toxic")


def calibrate(machine: Machine, scored: DataFrame) -> Machine:
    """Fits the logistic curve to all (decision, hits, toxic) rows, through
    their counts in hundredths of the decision."""
    b = F.round(F.col("decision") * 100).cast("long")
    got = scored.groupBy(b.alias("b"), F.least("hits", F.lit(HITS)).alias("h")).agg(F.count("*").alias("n"), F.sum("toxic").alias("y")).toArrow()
    x, h, n, y = (got.column(c).to_numpy().astype(float) for c in ("b", "h", "n", "y"))
    if not len(x) or y.sum() == 0 or y.sum() == n.sum():
        return machine
    x, w = x / 100, np.array([4.0, 0.0, 0.0])
    z = np.stack([x, np.log1p(h), np.ones(len(x))], axis=1)
    start = w.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
        grad = z.T @ (n * p - y) + 1e-2 * (w - start)
        hess = (z * (n * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(3)
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return Machine(machine.weights, machine.bias, *map(float, w))


def learnable(labels: DataFrame, train: Column) -> DataFrame:
    """(doc_id, toxic) of the labels that may be learned from; an id that is
    marked both ways counts as toxic."""
    return (labels.where(F.coalesce(train, F.lit(False)) & F.col("toxic").isNotNull()).groupBy("doc_id")
            .agg(F.max("toxic").cast("int").alias("toxic")))


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, doc_id: str = "doc_id", text: str = "text") -> Machine:
    """The machine, not calibrated yet."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    labelled = learnable(labels, train_on)
    n = labelled.count()
    if n > LABELLED:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * LABELLED / n))
    positive, negative, usual = units_of(slim, labelled)
    machine, frequent = train(positive, negative), len(negative)
    for _ in range(ROUNDS if positive else 0):
        found, name = decisions(usual, machine, "unit")
        hard = found.select("unit", F.col(name)["decision"].alias("f")).where("f > -1").orderBy(F.desc("f"), "unit").limit(FIT_HARD)
        more = sorted({r.unit for r in hard.collect()} - set(negative))
        if not more:
            break
        negative = negative + more
        machine = train(positive, negative, frequent)
    return machine


def score(docs: DataFrame, labels: DataFrame, train_on: Column, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Machine]:
    """(doc_id, score, unit) for each row, and the machine.  ``train_on`` is a
    condition on the label's ``doc_id``.

    Null, empty and unit-less texts get the machine's bias as decision; rows
    with a null id are scored but never learned from; repeated rows are scored
    one by one (and learned from one by one).  Without labels of both classes
    all scores are low and equal.
    """
    machine = fit(docs, labels, train_on, doc_id, text)
    found, name = decisions(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), machine)
    rows = materialize(found.select("doc_id", *[F.col(name)[c].alias(c) for c in ("decision", "unit", "hits")]), name="toxic")
    machine = calibrate(machine, rows.join(learnable(labels, train_on), "doc_id").select("decision", "hits", "toxic"))
    return rows.select("doc_id", machine.probability(F.col("decision"), F.col("hits")).alias("score"), "unit"), machine
