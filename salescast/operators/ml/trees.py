"""ML4–ML6: histogram trees, grown by Spark jobs — boosting with patience and a
leaf budget, and forests in restartable groups.

Rows are binned once and packed into blocks (a binary matrix of bins, targets and
current predictions for some thousand rows) and written to the shared folder.

Boosting grows one tree after the other, so what counts is the number of its jobs.
Blocks are dealt evenly to as many partitions as there are cores and cached with
their predictions of a few rounds ago; a pass adds the trees since and sums each
partition's rows into (node, feature, bin) histograms for all open nodes of a level,
and the driver adds these up, finds the splits and sends them with the next pass.
What is sent follows from the configuration, not from the rows.  Nodes that are small
enough for a task leave the passes: one job deals their rows to tasks that grow all
the rest of them.  A task adds up in the order of the partitions, like the driver, so
the trees are the same.

A forest's trees don't wait for each other, and are grown in groups, level by level:

* while a node has more rows than one task should hold, each task sums its rows
  into (node, feature, bin) histograms, which are added up per node, and the best
  split of a node is found where its histograms meet;
* the rows of a node that is small enough go to one task, which grows the rest of
  that subtree; a level has many such nodes, so this is spread like any shuffle.

Both use the same split search, so where the switch is made changes nothing but
the number of jobs.  Every pass is stateless: it takes the packed rows and the
splits so far, so a lost task or executor is repeated from the written table.

The driver holds one node table per boosted tree (at most 2^depth rows); the
trees of a forest are written by the tasks that grew them.
"""

from __future__ import annotations

import gc
import heapq
import json
import time
import uuid
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.session import shared_folder
from salescast.sources.io import exists

#: Rows of a block; bounds of the rows of a node that one task grows alone.
BLOCK, SMALL, LARGE = 8192, 1 << 19, 1 << 20
#: Bytes of the histograms that a task holds for the trees of a group.
GROUP_BYTES = 64 << 20
#: Rounds between two written states of a boosting run; trees that its passes add to
#: the rows' predictions before the rows are written with them, as adding one takes
#: less than writing; times rows are written between two checkpoints of them.
KEPT, CARRIED, CUT = 10, 5, 4
#: Rows of a partition of boosting, nodes of a pass, bytes of histograms that
#: the driver adds up itself.
PART, PASS, DRIVER_BYTES = 1 << 19, 512, 64 << 20
#: Rows that a task sums up at once, if they are of more than one node.
CACHED = 1 << 14
#: Rows of a boosted tree's node that one task grows alone, at least: growing so many
#: takes about as long as starting a pass.  A node with more than the share ``MOST`` of
#: its parent's rows tends to lose as few again, a pass each time: twice as many, but
#: no more than ``PART``.
ALONE, MOST = 1 << 18, 0.75


@dataclass(frozen=True)
class Params:
    """One configuration.  Leaves hold at least ``min_rows`` (weighted) rows; l1
    and l2 shrink leaf values and gains; ``max_leaves`` is kept by growing in
    order of gain; ``rows`` and ``columns`` are the shares sampled for each tree."""
    depth: int = 8
    min_rows: float = 1
    max_leaves: int | None = None
    rows: float = 1.0
    columns: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    step: float = 1.0
    bootstrap: bool = False
    seed: int = 42


PACKED = T.StructType([T.StructField("block", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.BinaryType()),
                       T.StructField("y", T.BinaryType()), T.StructField("f", T.BinaryType()), T.StructField("v", T.BinaryType())])
STATS = "tree int, node int, n double, total double, bytes binary"
NODES = "tree int, node int, feature int, bin int, gain double, n double, total double, below double"
NAMES, KINDS = ["tree", "node", "feature", "bin", "gain", "n", "total", "below"], (pa.int32(),) * 4 + (pa.float64(),) * 4


# ---- binning and packing

def edges(df: DataFrame, cols, bins: int) -> list[np.ndarray]:
    """Upper bounds of the bins of each column, from quantiles over all rows."""
    at = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), at, 100 * bins).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    out = []
    for q in row:
        q = np.unique(np.array([v for v in (q or []) if v == v], np.float64))
        out.append(q)
    return out


def binned(columns: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """Bin numbers, row by row; missing values are above all bounds."""
    out = np.empty((len(columns[0]), len(cuts)), np.uint8)
    for k, (x, cut) in enumerate(zip(columns, cuts)):
        out[:, k] = np.searchsorted(cut, x, side="left")
    return out


def _floats(column) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def pack(df: DataFrame, cols, label: str, cuts: list[np.ndarray], validation=None) -> DataFrame:
    """Blocks of binned rows; ``validation`` is a condition for rows that are
    only measured, not learned from."""
    flag = F.coalesce(validation, F.lit(False)) if validation is not None else F.lit(False)
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col(label).cast("double").alias("y"), flag.alias("v"))

    def run(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = binned([_floats(part.column(i)) for i in range(len(cuts))], cuts)
                y, v = _floats(part.column("y")), part.column("v").to_numpy(zero_copy_only=False).astype(np.uint8)
                here = ~np.isnan(y)
                x, y, v = x[here], y[here], v[here]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([len(y)], pa.int32()), pa.array([x.tobytes()]), pa.array([y.tobytes()]),
                     pa.array([np.zeros(len(y)).tobytes()]), pa.array([v.tobytes()])], names=PACKED.fieldNames())
                number += 1

    return rows.mapInArrow(run, PACKED)


def _blocks(batch, width: int):
    """(block, bins, y, f, validation flags) of each packed row."""
    for k in range(batch.num_rows):
        get = lambda c: batch.column(c)[k].as_buffer()
        yield (batch.column("block")[k].as_py(), np.frombuffer(get("x"), np.uint8).reshape(-1, width), np.frombuffer(get("y"), np.float64),
               np.frombuffer(get("f"), np.float64), np.frombuffer(get("v"), np.uint8).astype(bool))


# ---- split search

def weights(p: Params, tree: int, block: int, n: int) -> np.ndarray:
    """Times that each row of a block is in a tree's sample."""
    rng = np.random.default_rng([p.seed, tree, block])
    if p.bootstrap:
        return rng.poisson(p.rows, n).astype(np.float64)
    return (rng.random(n) < p.rows).astype(np.float64) if p.rows < 1 else np.ones(n)


def columns_of(p: Params, tree: int, width: int) -> np.ndarray:
    most = max(1, round(p.columns * width))
    return np.sort(np.random.default_rng([p.seed, tree]).permutation(width)[:most])


def _summed(mine: np.ndarray, slots: int, columns, wr: np.ndarray, w: np.ndarray | None, sizes: list[int]) -> list[np.ndarray]:
    """One after the other for each column, (weights, weighted targets) by slot and
    bin; rows without weights ``w`` are there once each."""
    out, base, key = [], {}, np.empty(len(mine), np.int64)
    for x, size in zip(columns, sizes):
        if size not in base:
            base[size] = mine * size
        np.add(base[size], x, out=key)
        out += [np.bincount(key, w, slots * size), np.bincount(key, wr, slots * size)]
    return out


def _opened_out(flat: np.ndarray, slots: int, sizes: list[int]) -> np.ndarray:
    """[2, slots, bins of all columns, one column after the other] from joined sums."""
    h, at, to = np.empty((2, slots, sum(sizes))), 0, 0
    for size in sizes:
        more = 2 * slots * size
        h[:, :, to:to + size] = flat[at:at + more].reshape(2, slots, size)
        at, to = at + more, to + size
    return h


def _score(total, n, p: Params):
    score, n = np.abs(total), n + p.l2
    score -= p.l1
    np.maximum(score, 0, out=score)
    score *= score
    score /= np.maximum(n, 1e-300, out=n)
    return score


def best_splits(h: np.ndarray, cols: np.ndarray, sizes: list[int], p: Params):
    """(feature, bin, gain, n, total, n up to the cut) of each slot; feature -1
    where no split gains and leaves enough rows on both sides.  Of equal gains
    the first feature and the lowest bin win."""
    ends = np.cumsum(sizes)
    starts, least = ends - sizes, max(p.min_rows, 1e-9)
    left, right = np.empty_like(h), np.empty_like(h)
    for lo, hi in zip(starts.tolist(), ends.tolist()):
        np.cumsum(h[:, :, lo:hi], axis=2, out=left[:, :, lo:hi])
        np.subtract(left[:, :, hi - 1:hi], left[:, :, lo:hi], out=right[:, :, lo:hi])
    n, total = left[0, :, ends[0] - 1], left[1, :, ends[0] - 1]
    whole = _score(total, n, p)
    # a cut after an empty bin is the cut before it
    slot, at = np.nonzero((h[0] > 0) & (left[0] >= least) & (right[0] >= least))
    gain = np.full(h.shape[1:], -np.inf)
    gain[slot, at] = _score(left[1, slot, at], left[0, slot, at], p) + _score(right[1, slot, at], right[0, slot, at], p) - whole[slot]
    at, every = gain.argmax(axis=1), np.arange(len(gain))
    best, of = gain[every, at], np.searchsorted(ends, at, side="right")
    ok = best > 1e-9 * np.maximum(1.0, whole)
    return np.where(ok, cols[of], -1), at - starts[of], np.where(ok, best, 0.0), n, total, left[0, every, at]


def grow_rest(x, r, w, root: int, p: Params, cols: np.ndarray, sizes: list[int]) -> list[tuple]:
    """All nodes below ``root`` (heap number) for the rows of one node, level by level.

    The rows of a node stand together, in the order they came in; of nodes that are
    not split any more only the first column is summed, for their totals.  Sums of
    whole numbers are exact in any order: there, of two siblings only the smaller
    is summed, and taken from the parent's sums for the other."""
    out, x, wr, own = [], np.ascontiguousarray(x[:, cols].T), w * r, [sizes[c] for c in cols]
    column = np.zeros(len(sizes), np.int64)
    column[cols] = np.arange(len(cols))
    exact = bool((wr == np.rint(wr)).all()) and float(np.abs(wr).sum()) < 2.0 ** 53
    fits = GROUP_BYTES // (16 * sum(own))  # nodes whose sums are held at once
    here, slot, parents = np.array([root]), np.zeros(len(wr), np.int64), None
    summed = open_ = int(root.bit_length() <= p.depth)
    while len(slot):
        rows = np.searchsorted(slot, np.arange(len(here) + 1))
        feature, cut = np.full(len(here), -1), np.zeros(len(here), np.int64)
        gain, n, total, below = np.zeros((4, len(here)))
        held = np.empty((2, open_, sum(own))) if exact and open_ <= fits else None

        def split_up(lo, hi, h):
            feature[lo:hi], cut[lo:hi], gain[lo:hi], n[lo:hi], total[lo:hi], below[lo:hi] = best_splits(h, cols, own, p)

        hi = 0
        while hi < summed:  # first the nodes that are summed, then those taken from a parent, then those not split any more
            lo, hi = hi, min(hi + PASS, summed, max(hi + 1, int(np.searchsorted(rows, rows[hi] + CACHED, side="right")) - 1))
            a = slice(rows[lo], rows[hi])
            h = _opened_out(np.concatenate(_summed(slot[a] - lo, hi - lo, x[:, a], wr[a], w[a], own)), hi - lo, own)
            if held is None:
                split_up(lo, hi, h)
            else:
                held[:, lo:hi] = h
        if held is not None:
            if parents is not None:
                held[:, summed:] = parents - held[:, twins]
            for lo in range(0, open_, PASS):
                split_up(lo, min(lo + PASS, open_), held[:, lo:lo + PASS])
        if open_ < len(here):
            a, more = slice(rows[open_], None), len(here) - open_
            n[open_:], total[open_:] = (q.reshape(more, -1).cumsum(axis=1)[:, -1]
                                        for q in _summed(slot[a] - open_, more, x[:1, a], wr[a], w[a], own[:1]))
        out += zip(*(q.tolist() for q in (here, feature, cut, gain, n, total, below)))
        split = np.flatnonzero(feature >= 0)
        sides = np.stack([below[split], n[split] - below[split]], axis=1)
        last = sides < 2 * p.min_rows if 2 * int(here[0]) < 1 << p.depth else np.ones(sides.shape, bool)
        kind = np.where(last, 2, 0)
        if held is not None and 2 * len(split) <= fits:
            larger = np.where(sides[:, 0] <= sides[:, 1], 1, 0)
            some, every = ~last.all(axis=1), np.arange(len(split))
            kind[every[some], larger[some]], kind[every[some], 1 - larger[some]] = 1, 0
        order = np.argsort(kind.ravel(), kind="stable")
        to = np.empty(2 * len(here), np.int64)
        to[(2 * split[:, None] + [0, 1]).ravel()[order]] = np.arange(len(order))
        summed, open_ = int((kind == 0).sum()), int((kind < 2).sum())
        taken = order[summed:open_]  # places of children; a child's sibling is one beside it
        parents = held[:, split[taken // 2]] if len(taken) else None
        twins = to[2 * split[taken // 2] + 1 - taken % 2]
        go = np.flatnonzero(feature.take(slot) >= 0)
        at = slot.take(go)
        slot = to.take(2 * at + (x[column[feature.take(at)], go] > cut.take(at)))
        moved = np.argsort(slot.astype(np.uint16) if len(order) < 1 << 16 else slot, kind="stable")
        slot, go, here = slot.take(moved), go.take(moved), (2 * here[split, None] + [0, 1]).ravel()[order]
        x, wr, w = x.take(go, axis=1), wr.take(go), w.take(go)
    return out


@dataclass
class Tree:
    """Arrays by heap number (root 1); feature -1 marks a leaf or nothing."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        size = 2 << depth
        return cls(np.full(size, -1, np.int16), np.zeros(size, np.uint8), np.zeros(size), np.zeros(size))

    def split(self, k: int, feature: int, cut: int) -> None:
        """Splits node ``k``; the arrays grow to hold its children."""
        size = len(self.feature)
        if 2 * k + 1 >= size:
            more = Tree.empty(k.bit_length())
            for name in ("feature", "cut", "value", "gain"):
                getattr(more, name)[:size] = getattr(self, name)
                setattr(self, name, getattr(more, name))
        self.feature[k], self.cut[k] = feature, cut

    def leaf(self, x: np.ndarray) -> np.ndarray:
        node, at = np.ones(len(x), np.int64), np.arange(len(x))
        while True:
            f = self.feature[node]
            go = f >= 0
            if not go.any():
                return node
            node = np.where(go, 2 * node + (x[at, f] > self.cut[node]), node)


def budgeted(nodes: dict[int, tuple], p: Params) -> Tree:
    """The tree of ``nodes`` (number -> feature, cut, gain, n, total, ...): the leaf
    whose split gains most is split next, until ``max_leaves`` are there.  A
    split's gain does not depend on what was split before it elsewhere, so this
    equals growing leaf by leaf."""
    tree = Tree.empty(p.depth)
    leaves, open_ = 1, [(-nodes[1][2], 1)] if nodes[1][0] >= 0 else []
    value = lambda k: np.sign(nodes[k][4]) * max(abs(nodes[k][4]) - p.l1, 0) / (nodes[k][3] + p.l2) if nodes[k][3] + p.l2 > 0 else 0.0
    tree.value[1] = value(1)
    while open_ and (p.max_leaves is None or leaves < p.max_leaves):
        _, k = heapq.heappop(open_)
        tree.feature[k], tree.cut[k], tree.gain[k] = nodes[k][:3]
        leaves += 1
        for child in (2 * k, 2 * k + 1):
            tree.value[child] = value(child)
            if nodes[child][0] >= 0:
                heapq.heappush(open_, (-nodes[child][2], child))
    return tree


# ---- growing by jobs

class Grower:
    """Grows some trees at once over packed rows whose targets are y - f, f less
    what ``since`` trees added after the rows were written."""

    def __init__(self, rows: DataFrame, p: Params, sizes: list[int], small: int, since=()):
        self.rows, self.p, self.sizes, self.small = rows, p, sizes, small
        self.since = [_compact(t, p.step) for t in since]

    def _sums(self, trees: dict[int, Tree], open_: dict[int, np.ndarray]) -> DataFrame:
        """Best splits of the open nodes, a row each, and one row of tree -1 with
        the number and squared error of the validation rows."""
        p, sizes, width, since = self.p, self.sizes, len(self.sizes), self.since

        def run(batches):
            held, loss, n_loss = {}, 0.0, 0.0
            for batch in batches:
                for block, x, y, f, v in _blocks(batch, width):
                    r, learn, x = y - f - _scores(since, x), ~v, np.ascontiguousarray(x.T)
                    loss, n_loss = loss + float((r[v] ** 2).sum()), n_loss + float(v.sum())
                    for t, nodes in open_.items():
                        w, cols = weights(p, t, block, len(y)) * learn, columns_of(p, t, width)
                        slot = np.full(len(trees[t].feature), -1, np.int64)
                        slot[nodes] = np.arange(len(nodes))
                        mine = slot.take(_nodes(trees[t], x))
                        a = np.flatnonzero((mine >= 0) & (w > 0))
                        mine, w = mine.take(a), w.take(a)
                        h = np.concatenate(_summed(mine, len(nodes), (x[c].take(a) for c in cols), w * r.take(a), w, [sizes[c] for c in cols]))
                        held[t] = held[t] + h if t in held else h
            held = {t: _opened_out(h, len(open_[t]), [sizes[c] for c in columns_of(p, t, width)]) for t, h in held.items()}
            out = [(t, int(node), 0.0, 0.0, h[:, k].tobytes()) for t, h in held.items() for k, node in enumerate(open_[t])]
            out.append((-1, 0, n_loss, loss, b""))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.binary()))],
                                             names=["tree", "node", "n", "total", "bytes"])

        def meet(key, table):
            t, node = key[0].as_py(), key[1].as_py()
            if t < 0:
                row = (-1, 0, -1, 0, 0.0, sum(table.column("n").to_pylist()), sum(table.column("total").to_pylist()), 0.0)
            else:
                cols = columns_of(p, t, width)
                h = sum(np.frombuffer(b.as_buffer(), np.float64).reshape(2, 1, -1) for b in table.column("bytes"))
                split = best_splits(h, cols, [sizes[c] for c in cols], p)
                row = (t, node, *(q[0] for q in split))
            return pa.table([pa.array([v], k) for v, k in zip(row, KINDS)], names=NAMES)

        return self.rows.mapInArrow(run, STATS).groupBy("tree", "node").applyInArrow(meet, NODES)

    def _rest(self, trees: dict[int, Tree], ends: dict[int, np.ndarray]) -> DataFrame:
        """Node rows of the subtrees below ``ends``, each grown by one task, and
        the row of tree -1 as in ``_sums``."""
        p, sizes, width, since = self.p, self.sizes, len(self.sizes), self.since

        def deal(batches):
            for batch in batches:
                for block, x, y, f, v in _blocks(batch, width):
                    r, learn, by_column = y - f - _scores(since, x), ~v, np.ascontiguousarray(x.T)
                    out = [(-1, 0, b"", np.array([v.sum(), (r[v] ** 2).sum()]).tobytes(), b"")]
                    for t, nodes in ends.items():
                        w = weights(p, t, block, len(y)) * learn
                        slot = np.full(len(trees[t].feature), -1, np.int64)
                        slot[nodes] = np.arange(len(nodes))
                        mine = slot.take(_nodes(trees[t], by_column))
                        a = np.flatnonzero((mine >= 0) & (w > 0))
                        mine = mine.take(a)
                        order = np.argsort(mine.astype(np.uint16) if len(nodes) < 1 << 16 else mine, kind="stable")
                        mine, a = mine.take(order), a.take(order)
                        for part, k in zip(np.split(a, np.flatnonzero(np.diff(mine)) + 1), np.unique(mine)):
                            out.append((t, int(nodes[k]), x[part].tobytes(), r[part].tobytes(), w[part].tobytes()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int32()) + (pa.binary(),) * 3)],
                                                     names=["tree", "node", "x", "r", "w"])

        def finish(key, table):
            t, root = key[0].as_py(), key[1].as_py()
            joined = {c: b"".join(table.column(c).to_pylist()) for c in ("x", "r", "w")}
            r = np.frombuffer(joined["r"], np.float64)
            if t < 0:
                nodes = [(0, -1, 0, 0.0, float(r[0::2].sum()), float(r[1::2].sum()), 0.0)]
            else:
                x = np.frombuffer(joined["x"], np.uint8).reshape(-1, width)
                nodes = grow_rest(x, r, np.frombuffer(joined["w"], np.float64), root, p, columns_of(p, t, width), sizes)
            return pa.table([pa.array(c, k) for c, k in zip([[t] * len(nodes), *map(list, zip(*nodes))], KINDS)], names=NAMES)

        dealt = self.rows.mapInArrow(deal, "tree int, node int, x binary, r binary, w binary")
        # a number of partitions of its own: the rows of an end are few bytes and much work
        spread = min(sum(map(len, ends.values())) + 1, 4 * self.rows.sparkSession.sparkContext.defaultParallelism)
        return dealt.repartition(spread, "tree", "node").groupBy("tree", "node").applyInArrow(finish, NODES)

    def top(self, numbers, n: int) -> tuple[dict[int, dict[int, tuple]], dict[int, Tree], dict[int, np.ndarray], tuple | None]:
        """Splits of all nodes too large for one task: (nodes of each tree,
        partial trees, ends to be grown by a task, validation rows and their
        squared error if a pass has seen them).  ``n`` is the number of rows."""
        nodes = {t: {} for t in numbers}
        trees = {t: Tree.empty(0) for t in numbers}
        if n <= self.small:
            return nodes, trees, {t: np.array([1]) for t in numbers}, None
        open_ = {t: np.array([1]) for t in numbers}
        ends, loss = {t: [] for t in numbers}, None
        while open_:
            grown, nxt = self._sums(trees, open_).collect(), {}
            for r in grown:
                t, k = r["tree"], r["node"]
                if t < 0:
                    loss = (r["n"], r["total"])
                    continue
                feature = r["feature"] if k.bit_length() <= self.p.depth else -1
                nodes[t][k] = (feature, r["bin"], r["gain"], r["n"], r["total"], r["below"])
                if feature < 0:
                    continue
                trees[t].split(k, feature, r["bin"])
                for child, size in ((2 * k, r["below"]), (2 * k + 1, r["n"] - r["below"])):
                    (ends[t] if size <= self.small else nxt.setdefault(t, [])).append(child)
            open_ = {t: np.array(sorted(ks)) for t, ks in nxt.items()}
        return nodes, trees, {t: np.array(sorted(ks)) for t, ks in ends.items() if ks}, loss

    def whole(self, number: int, n: int) -> tuple[dict[int, tuple], tuple[float, float]]:
        """All nodes of one tree, on the driver, and the validation rows' error."""
        nodes, trees, ends, loss = self.top([number], n)
        if ends:
            for r in self._rest(trees, ends).collect():
                if r["tree"] < 0:
                    loss = (r["n"], r["total"])
                else:
                    nodes[number][r["node"]] = (r["feature"], r["bin"], r["gain"], r["n"], r["total"], r["below"])
        return nodes[number], loss


def _spread(packed: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Packed rows over all cores and cached, and the rows of a node for one task."""
    spark = packed.sparkSession
    cores = spark.sparkContext.defaultParallelism
    parts = int(min(2000, max(cores, rows // (1 << 21))))
    small = int(min(LARGE, max(SMALL, rows // (2 * cores))))
    return packed.repartition(parts, "block").persist(), small


def _prepared(train: DataFrame, cols, label: str, bins: int, folder: str, validation, made=None) -> tuple[DataFrame, list[np.ndarray], int]:
    """The packed table of a run and its bin edges (from ``made``, if given); read
    where a run left them."""
    spark = train.sparkSession
    if not exists(spark, f"{folder}/rows/_SUCCESS"):
        cuts = made() if made else edges(train, cols, bins)
        pack(train, cols, label, cuts, validation).write.mode("overwrite").parquet(f"{folder}/rows")
        spark.createDataFrame([(json.dumps([c.tolist() for c in cuts]),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/edges")
    cuts = [np.array(c) for c in json.loads(spark.read.text(f"{folder}/edges").first()[0])]
    packed = spark.read.schema(PACKED).parquet(f"{folder}/rows")
    return packed, cuts, int(packed.agg(F.sum("n")).first()[0] or 0)


class GivenUp(Exception):
    """A run was ended from outside; what it has written stays."""


def _go_on(stop) -> None:
    if stop and stop():
        raise GivenUp


def run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/salescast-trees/{name}-{uuid.uuid4().hex}"


# ---- boosting

class Patience:
    """Stops after ``rounds`` rounds without a better validation error; a pause
    of fewer rounds does not end the run."""

    def __init__(self, rounds: int):
        self.rounds, self.curve = rounds, []

    def add(self, error: float) -> bool:
        self.curve.append(error)
        return len(self.curve) - self.best >= self.rounds

    @property
    def best(self) -> int:
        """Rounds up to the first smallest error; 0 is the constant model."""
        return int(np.argmin(self.curve)) if self.curve else 0


_settled = False


def _settle() -> None:
    """Once a Python worker: takes what it has loaded out of the garbage collection
    that Spark makes after each task, which took longer than a pass itself."""
    global _settled
    if not _settled:
        gc.collect()
        gc.freeze()
        _settled = True


def _held(packed: DataFrame, width: int, n: int):
    """An RDD of one element a partition: its rows' bins by column, targets,
    predictions, validation flags, and (number, rows) of its blocks."""
    cores = packed.sparkSession.sparkContext.defaultParallelism
    sizes = sorted(((r["n"], r["block"]) for r in packed.select("n", "block").collect()), reverse=True)  # one a block
    parts = max(1, min(len(sizes), max(cores, n // PART)))
    free, place = [(0, k) for k in range(parts)], {}
    for rows, block in sizes:
        load, k = heapq.heappop(free)
        place[block] = k
        heapq.heappush(free, (load + rows, k))

    def load(items):
        rows = sorted((r for _, r in items), key=lambda r: r["block"])
        if rows:
            joined = lambda c, kind: np.frombuffer(b"".join(bytes(r[c]) for r in rows), kind)
            x = np.ascontiguousarray(joined("x", np.uint8).reshape(-1, width).T)
            yield x, joined("y", np.float64), joined("f", np.float64), joined("v", np.uint8).astype(bool), [(r["block"], r["n"]) for r in rows]

    return packed.rdd.map(lambda r: (place[r["block"]], r)).partitionBy(parts, lambda k: k).mapPartitions(load)


def _nodes(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The node that each row is in; ``x`` is by column.  A leaf leads to itself:
    its cut is above all bins."""
    n, flat, inner = x.shape[1], x.ravel(), tree.feature >= 0
    first = np.where(inner, tree.feature.astype(np.int64) * n, 0)
    to, cut = np.where(inner, 2, 1) * np.arange(len(inner)), np.where(inner, tree.cut, 255).astype(np.uint8)
    node, at = np.ones(n, np.int64), np.arange(n)
    for _ in range(int(np.flatnonzero(inner).max(initial=0)).bit_length()):
        node = to.take(node) + (flat.take(first.take(node) + at) > cut.take(node))
    return node


def _with(f: np.ndarray, trees: list[Tree], x: np.ndarray, step: float) -> np.ndarray:
    """Predictions with more trees in them; ``x`` is by column."""
    for t in trees:
        f = f + (t.value * step).take(_nodes(t, x))
    return f


def _moved(rows, trees: list[Tree], step: float, base: float | None = None):
    """Rows with more trees, or the constant they start from, in their predictions."""
    def run(parts):
        _settle()
        for x, y, f, v, blocks in parts:
            yield x, y, _with(f if base is None else np.full(len(y), base), trees, x, step), v, blocks
    return rows.mapPartitions(run)


def _sample(p: Params, number: int, v: np.ndarray, blocks) -> np.ndarray:
    """Times that each row of a partition is in a tree's sample."""
    w = np.concatenate([weights(p, number, b, k) for b, k in blocks])
    w[v] = 0
    return w


def _passed(rows, p: Params, number: int, tree: Tree, open_: np.ndarray, cols: np.ndarray, sizes: list[int], since=()):
    """(histograms of the open nodes, validation rows and their squared error);
    the trees ``since`` are not in the rows' predictions yet."""
    own = [sizes[c] for c in cols]

    def run(parts):
        _settle()
        for x, y, f, v, blocks in parts:
            r = y - _with(f, since, x, p.step)
            held, loss = float(v.sum()), float((r[v] ** 2).sum())
            w = _sample(p, number, v, blocks)
            slot = np.full(len(tree.feature), -1, np.int64)
            slot[open_] = np.arange(len(open_))
            mine = slot.take(_nodes(tree, x))
            a = np.flatnonzero((mine >= 0) & (w > 0))
            mine, w = mine[a], w[a]
            yield np.concatenate([[held, loss], *_summed(mine, len(open_), (x[c].take(a) for c in cols), w * r[a], w if p.bootstrap else None, own)])

    sums, size = rows.mapPartitions(run), 8 * len(open_) * 2 * sum(own)
    if rows.getNumPartitions() * size > DRIVER_BYTES:
        flat = sums.treeReduce(np.add)
    else:
        flat = sum(sums.collect())
    return _opened_out(flat[2:], len(open_), own), (flat[0], flat[1])


def _put(nodes: dict[int, tuple], some, h: np.ndarray, cols: np.ndarray, own: list[int], p: Params) -> None:
    """Adds the nodes ``some`` of histograms ``h``, and what their children are if
    they are not split."""
    feature, cut, gain, n, total, below = best_splits(h, cols, own, p)
    starts = dict(zip(cols.tolist(), (np.cumsum(own) - own).tolist()))
    for s, k in enumerate(some):
        f = int(feature[s]) if k.bit_length() <= p.depth else -1
        nodes[k] = (f, int(cut[s]), float(gain[s]), float(n[s]), float(total[s]), float(below[s]))
        if f >= 0:
            left = float(h[1, s, starts[f]:starts[f] + cut[s] + 1].sum())
            rest = (n[s] - below[s], total[s] - left)
            nodes[2 * k], nodes[2 * k + 1] = ((-1, 0, 0.0, float(a), float(b), 0.0) for a, b in ((below[s], left), rest))


def _split(tree: Tree, nodes: dict[int, tuple], level: list[int], p: Params) -> list[int]:
    """Splits the wanted nodes of a level; returns the children to be looked at."""
    grown = _wanted(nodes, level, p)
    for k in grown:
        tree.split(k, nodes[k][0], nodes[k][1])
    return [c for k in grown for c in (2 * k, 2 * k + 1) if c.bit_length() <= p.depth and nodes[c][3] >= 2 * p.min_rows]


def _finished(rows, p: Params, number: int, tree: Tree, nodes: dict[int, tuple], ends: list[int], cols: np.ndarray,
              sizes: list[int], since=()) -> dict[int, tuple]:
    """The nodes of the subtrees of ``ends``, grown by tasks that are dealt their rows."""
    own = [sizes[c] for c in cols]
    parts = min(len(ends), rows.getNumPartitions())
    free, place = [(0.0, k) for k in range(parts)], {}
    for k in sorted(ends, key=lambda k: (-nodes[k][3], k)):
        load, at = heapq.heappop(free)
        place[k] = at
        heapq.heappush(free, (load + nodes[k][3], at))
    top = {k: v for k, v in nodes.items() if k not in place}

    def deal(index, parts_):
        _settle()
        for x, y, f, v, blocks in parts_:
            w, node, r, own_x = _sample(p, number, v, blocks), _nodes(tree, x), y - _with(f, since, x, p.step), x[cols]
            to = np.full(len(tree.feature), -1, np.int64)
            to[list(place)] = list(place.values())
            to = np.where(w > 0, to.take(node), -1)
            for k in range(parts):
                a = np.flatnonzero(to == k)
                if len(a):
                    yield k, (index, node[a].astype(np.int32), own_x.take(a, axis=1), w[a] * r[a], w[a] if p.bootstrap else None)

    def finish(items):
        _settle()
        chunks = sorted((c for _, c in items), key=lambda c: c[0])
        here = np.unique(np.concatenate([c[1] for c in chunks])).tolist() if chunks else []
        mine, open_, part = {**top, **{k: nodes[k] for k in here}}, here, Tree.empty(p.depth)
        chunks = [c[1:] for c in chunks]
        while open_:
            for lo in range(0, len(open_), PASS):
                some = open_[lo:lo + PASS]
                slot = np.full(2 << p.depth, -1, np.int64)
                slot[some] = np.arange(len(some))
                h = 0
                for node, x, wr, w in chunks:
                    at = slot.take(node)
                    if len(some) < len(open_):
                        a = np.flatnonzero(at >= 0)
                        at, x, wr, w = at[a], x.take(a, axis=1), wr[a], None if w is None else w[a]
                    h = h + np.concatenate(_summed(at, len(some), x, wr, w, own))
                _put(mine, some, _opened_out(h, len(some), own), cols, own, p)
            open_ = _split(part, mine, open_, p)
            left = np.zeros(2 << p.depth, bool)
            left[open_] = True
            column, moved = np.searchsorted(cols, part.feature), []
            for node, x, wr, w in chunks:
                a = np.flatnonzero(part.feature.take(node) >= 0)
                node = node.take(a)
                node = 2 * node + (x[column.take(node), a] > part.cut.take(node))
                go = np.flatnonzero(left.take(node))
                a = a.take(go)
                moved.append((node.take(go), x.take(a, axis=1), wr.take(a), None if w is None else w.take(a)))
            chunks = moved
        yield {k: v for k, v in mine.items() if k not in top}

    dealt = rows.mapPartitionsWithIndex(deal).partitionBy(parts, lambda k: k).mapPartitions(finish)
    out = {k: v for found in dealt.collect() for k, v in found.items()}
    dealt._jrdd.rdd().cleanShuffleDependencies(False)  # else the rows of all rounds stay on the disks
    return out


def _wanted(nodes: dict[int, tuple], level: list[int], p: Params) -> list[int]:
    """The nodes of a level whose children may be needed: ``budgeted`` splits in
    order of the least gain on a node's path, so a node behind ``max_leaves - 1``
    others there is never split."""
    split = [k for k in level if nodes[k][0] >= 0]
    if p.max_leaves is None:
        return split
    least = {}
    for k in sorted(k for k, v in nodes.items() if v[0] >= 0):
        least[k] = min(nodes[k][2], least.get(k // 2, np.inf))
    ahead = sorted(least.values(), reverse=True)[:max(0, p.max_leaves - 1)]
    return [k for k in split if len(ahead) < p.max_leaves - 1 or least[k] >= ahead[-1]] if ahead else []


def _grown(rows, p: Params, number: int, sizes: list[int], alone: int = 0, since=()) -> tuple[dict[int, tuple], tuple[float, float]]:
    """All nodes of one tree that may be needed, and the validation rows' number
    and squared error.  Below the root, nodes of at most ``alone`` rows (twice that
    where little was split off) that three or more passes would follow are grown by
    a task each."""
    cols, twice = columns_of(p, number, len(sizes)), max(alone, min(2 * alone, PART))
    nodes, tree, open_, ends, loss = {}, Tree.empty(0), [1], [], None
    while open_:
        for lo in range(0, len(open_), PASS):
            some = np.array(open_[lo:lo + PASS])
            h, loss = _passed(rows, p, number, tree, some, cols, sizes, since)
            _put(nodes, some.tolist(), h, cols, [sizes[c] for c in cols], p)
        below = _split(tree, nodes, open_, p)
        most = {k: twice if nodes[k][3] > MOST * nodes[k // 2][3] else alone for k in below}
        open_ = [k for k in below if nodes[k][3] > most[k] or k.bit_length() + 2 > p.depth]
        ends += sorted(set(below) - set(open_))
    if ends:
        nodes |= _finished(rows, p, number, tree, nodes, ends, cols, sizes, since)
    return nodes, loss


def boost(train: DataFrame, cols, label: str, p: Params, rounds: int, patience: int | None = None, validation=None, bins: int = 64,
          folder: str | None = None, kept: int = KEPT, on_block=None, made=None, stop=None) -> "Ensemble":
    """Boosted trees for squared error; the model is cut back to its best round.

    The constant model (the mean of the training rows) is round 0; after each
    round the error over the ``validation`` rows is known and the run stops after
    ``patience`` rounds without a better one.  Every ``kept`` rounds the trees
    and the curve are written below ``folder``; a run that finds them there scores
    its rows by them and goes on from the last complete block, with the same result.
    ``on_block`` is called with the number of rounds after each of these.  ``made``
    gives the bin edges; a run whose ``stop`` says so ends with ``GivenUp``.
    """
    spark, began = train.sparkSession, time.time()
    folder = (folder or run_folder(spark, "boost")).rstrip("/")
    packed, cuts, n = _prepared(train, cols, label, bins, folder, validation, made)
    width = len(cols)
    sizes = [1 + len(c) for c in cuts]
    base, trees, curve, at = None, [], [], 0
    while exists(spark, f"{folder}/block-{at + kept}/done/_SUCCESS"):
        at += kept
        state = json.loads(spark.read.text(f"{folder}/block-{at}/done").first()[0])
        base, curve = state["base"], state["curve"]
        trees += [_tree(t, p.depth) for t in state["trees"]]
    held = _held(packed, width, n)
    if base is None:
        sums = held.map(lambda q: np.array([q[1][~q[3]].sum(), (~q[3]).sum()])).fold(np.zeros(2), np.add)
        base = float(sums[0] / sums[1]) if sums[1] else 0.0
    rows = _moved(held, trees, p.step, base).persist(StorageLevel.MEMORY_AND_DISK)
    alone, moved, moves = max(ALONE, n // held.getNumPartitions()), len(trees), 0
    waits, ended, last = Patience(patience or rounds + 1), False, None
    waits.curve = curve
    while len(trees) < rounds and n:
        _go_on(stop)
        number = len(trees) + 1
        nodes, (n_valid, loss) = _grown(rows, p, number, sizes, alone, trees[moved:])
        if last is not None:  # its rows were made into this round's by the first pass
            last.unpersist()
            last = None
        # the pass for a round measures the rounds before it
        if len(waits.curve) < number and n_valid:
            ended = waits.add(float(np.sqrt(loss / n_valid)))
            if ended:
                break
        trees.append(budgeted(nodes, p))
        if number - moved >= CARRIED:
            last, rows = rows, _moved(rows, trees[moved:], p.step).persist(StorageLevel.MEMORY_AND_DISK)
            moved, moves = number, moves + 1
            if moves % CUT == 0:  # a lost executor's rows are not made from the first round on
                rows.checkpoint()
        if number % kept == 0 and number < rounds:
            state = {"base": base, "curve": waits.curve, "trees": [_listed(t) for t in trees[-kept:]]}
            spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/block-{number}/done")
            if on_block:
                on_block(number)
    if not ended and n and len(waits.curve) == len(trees):  # the last round's error
        _, (n_valid, loss) = _passed(rows, p, 0, Tree.empty(0), np.zeros(0, np.int64), columns_of(p, 0, width), sizes, trees[moved:])
        if n_valid:
            waits.add(float(np.sqrt(loss / n_valid)))
    for held in (rows, last):
        if held is not None:
            held.unpersist()
    best = waits.best if waits.curve else len(trees)
    tables = [_compact(t, p.step) for t in trees[:best]]
    return Ensemble("boost", list(cols), cuts, tables, base, rounds=len(trees), best_round=best, curve=list(waits.curve),
                    seconds=time.time() - began, gains=_gains(trees[:best], width), params=asdict(p))


def _listed(tree: Tree) -> list:
    used = np.flatnonzero((tree.feature >= 0) | (tree.value != 0))
    return [used.tolist(), *(a[used].tolist() for a in (tree.feature, tree.cut, tree.value, tree.gain))]


def _tree(listed: list, depth: int) -> Tree:
    tree, at = Tree.empty(depth), np.array(listed[0], np.int64)
    for a, values in zip((tree.feature, tree.cut, tree.value, tree.gain), listed[1:]):
        a[at] = values
    return tree


def _gains(trees, width: int) -> np.ndarray:
    """Gain of all splits on each feature."""
    return sum((np.bincount(t.feature[t.feature >= 0], t.gain[t.feature >= 0], width) for t in trees), np.zeros(width))


def _compact(tree: Tree, step: float) -> tuple:
    """(feature, cut, first child, value) arrays over the nodes that exist."""
    order, child = [1], []
    for k in order:
        inner = tree.feature[k] >= 0
        child.append(len(order) if inner else -1)
        if inner:
            order += [2 * k, 2 * k + 1]
    at = np.array(order)
    return tree.feature[at].astype(np.int16), tree.cut[at], np.array(child, np.int32), tree.value[at] * step


# ---- forest

def forest(train: DataFrame, cols, label: str, p: Params, trees: int, bins: int = 64, folder: str | None = None,
           group: int | None = None, parallelism: int = 2, made=None, stop=None) -> "Ensemble":
    """Trees over bootstrap samples, grown in groups that are jobs of their own.

    A group is as large as the histograms of its trees allow (``GROUP_BYTES`` a
    task) unless given.  Each group's node table is written below ``folder``; a
    run that finds complete ones grows only the others.  A tree's sample follows
    from the seed, its number and the block of a row, so the model is the same
    whatever the groups.  ``made`` and ``stop`` are those of ``boost``.
    """
    from concurrent.futures import ThreadPoolExecutor

    spark, began = train.sparkSession, time.time()
    folder = (folder or run_folder(spark, "forest")).rstrip("/")
    packed, cuts, n = _prepared(train, cols, label, bins, folder, None, made)
    width, sizes = len(cols), [1 + len(c) for c in cuts]
    rows, small = _spread(packed, n)
    if group is None:
        frontier = max(1, 2 * n // small)
        group = int(max(1, min(25, trees, GROUP_BYTES // (frontier * width * max(sizes, default=1) * 16))))

    def group_path(first: int) -> str:
        """Has the trees in its name: a run of fewer ends with a shorter group."""
        return f"{folder}/groups-{group}/group-{first}-{min(first + group, trees)}"

    def grow(first: int) -> None:
        numbers = list(range(first, min(first + group, trees)))
        path = group_path(first)
        _go_on(stop)
        if exists(spark, f"{path}/_SUCCESS"):
            return
        grower = Grower(rows, p, sizes, small)
        nodes, partial, ends, _ = grower.top(numbers, n)
        out = spark.createDataFrame([(t, k, *v) for t, ns in nodes.items() for k, v in ns.items()], NODES)
        if ends:
            out = grower._rest(partial, ends).where("tree >= 0").unionByName(out)
        out.write.mode("overwrite").parquet(path)

    if n:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(grow, range(0, trees, group)))
    rows.unpersist()
    nodes = spark.read.schema(NODES).parquet(*[group_path(k) for k in range(0, trees, group)]) if n else None
    gains = np.zeros(width)
    tables = []
    if n:
        for r in nodes.where("feature >= 0").groupBy("feature").agg(F.sum("gain").alias("gain")).collect():
            gains[r["feature"]] = r["gain"]
        tables = _tables(nodes)
    return Ensemble("forest", list(cols), cuts, tables, 0.0, rounds=len(tables), best_round=len(tables), curve=[],
                    seconds=time.time() - began, gains=gains, params=asdict(p))


def _tables(nodes: DataFrame) -> list[tuple]:
    """Compact arrays of each tree, made by the tasks that gather its nodes."""
    def pack_tree(key, table):
        k = table.column("node").to_numpy()
        order = np.argsort(k)
        k, feature, cut = k[order], table.column("feature").to_numpy()[order], table.column("bin").to_numpy()[order]
        n, total = table.column("n").to_numpy()[order], table.column("total").to_numpy()[order]
        child = np.where(feature >= 0, np.searchsorted(k, 2 * k), -1)
        value = np.divide(total, n, out=np.zeros(len(n)), where=n > 0)
        parts = [feature.astype(np.int16), cut.astype(np.uint8), child.astype(np.int32), value]
        return pa.table([pa.array([key[0].as_py()], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in parts]],
                        names=["tree", "feature", "cut", "child", "value"])

    packed = nodes.groupBy("tree").applyInArrow(pack_tree, "tree int, feature binary, cut binary, child binary, value binary")
    return [(np.frombuffer(r["feature"], np.int16), np.frombuffer(r["cut"], np.uint8), np.frombuffer(r["child"], np.int32),
             np.frombuffer(r["value"], np.float64)) for r in sorted(packed.collect(), key=lambda r: r["tree"])]


# ---- the model

def _scores(tables, x: np.ndarray) -> np.ndarray:
    """Sum of the trees' values.  A leaf leads to itself: its cut is above all bins."""
    total, flat, base = np.zeros(len(x)), np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    for feature, cut, child, value in tables:
        leaf = feature < 0
        f, c, to = np.where(leaf, 0, feature), np.where(leaf, 255, cut), np.where(leaf, np.arange(len(leaf)), child)
        node = np.zeros(len(x), np.int64)
        while True:
            onward = to.take(node) + (flat.take(base + f.take(node)) > c.take(node))
            if (onward == node).all():
                break
            node = onward
        total += value.take(node)
    return total


@dataclass
class Ensemble:
    """Fitted trees: base + sum for boosting, mean for a forest."""
    kind: str
    cols: list
    cuts: list
    tables: list
    base: float
    rounds: int
    best_round: int
    curve: list
    seconds: float
    gains: np.ndarray
    params: dict = field(default_factory=dict)

    @property
    def leaves(self) -> list[int]:
        return [int((t[0] < 0).sum()) for t in self.tables]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``; the trees are sent to each executor once.
        Their size follows the configuration, not the data."""
        cols, kind, base = self.cols, self.kind, self.base
        at = [df.columns.index(c) for c in cols]
        sent = df.sparkSession.sparkContext.broadcast((self.cuts, self.tables))

        def run(batches):
            cuts, tables = sent.value
            for batch in batches:
                x = binned([_floats(batch.column(i)) for i in at], cuts)
                score = _scores(tables, x)
                score = base + score if kind == "boost" else score / max(1, len(tables))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "prediction"])

        return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("prediction", T.DoubleType())]))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, *(a.tobytes() for a in t)) for i, t in enumerate(self.tables)]
        spark.createDataFrame(rows, "tree int, feature binary, cut binary, child binary, value binary").write.mode("overwrite").parquet(f"{path}/trees")
        about = {k: getattr(self, k) for k in ("kind", "cols", "base", "rounds", "best_round", "curve", "seconds", "params")}
        about |= {"cuts": [c.tolist() for c in self.cuts], "gains": self.gains.tolist()}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/ensemble")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Ensemble":
        about = json.loads(spark.read.text(f"{path}/ensemble").first()[0])
        rows = sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r["tree"])
        tables = [tuple(np.frombuffer(r[c], k) for c, k in (("feature", np.int16), ("cut", np.uint8), ("child", np.int32), ("value", np.float64)))
                  for r in rows]
        return cls(**{**about, "cuts": [np.array(c) for c in about["cuts"]], "gains": np.array(about["gains"])}, tables=tables)
