"""Vector and word operators against brute force, and their edge cases."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.llm import spelling, tiles, whitening

VEC = "vec_id long, embedding array<double>, label int, n_links string, kept double"


# ---- near-duplicate vectors

def vectors(seed=5):
    """Clusters around the threshold, copies, scaled copies, and every kind of row that cannot link."""
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for label in (0, 1, 1, 1, 2, None):
        base = rng.standard_normal(12)
        for spread in np.linspace(0, 0.12, 30):
            rows.append((k, (base + spread * rng.standard_normal(12)).tolist(), label, "x", None))
            k += 1
    rows += [rows[3], rows[3], (7, rows[40][1], 1, None, 1.0), (None, rows[41][1], 1, None, None),
             (1000, (7.5 * np.array(rows[42][1])).tolist(), 1, None, None), (1001, (1e-200 * np.array(rows[42][1])).tolist(), 1, None, None),
             (1002, (1e200 * np.array(rows[42][1])).tolist(), 1, None, None), (1003, (-np.array(rows[42][1])).tolist(), 1, None, None)]
    odd = [None, [], [0.0] * 12, [None] + [1.0] * 11, [float("nan")] * 12, [float("inf")] + [1.0] * 11, [1.0] * 5, [2.0] * 5, [0.0, -0.0]]
    rows += [(2000 + i, v, 1, None, None) for i, v in enumerate(odd)] + [(None, None, None, None, None), (None, [1.0, 2.0], 9, None, None)]
    return rows


def brute_near(rows, threshold=0.98):
    def fine(r):
        return r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    unit = {i: np.array(r[1]) / np.abs(r[1]).max() / np.linalg.norm(np.array(r[1]) / np.abs(r[1]).max()) for i, r in enumerate(rows) if fine(r)}
    links = collections.defaultdict(list)
    for i in unit:
        for j in unit:
            if i != j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i].append(j)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((r[0], len(links[i]), least, r[0] == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_bytes, tile", [(8 << 20, 1024), (12 * 8 * 7, 4), (12 * 8 * 40, 16)])
def test_near_vectors_match_brute_force(spark, chunk_bytes, tile):
    rows = vectors()
    got = tiles.near(spark.createDataFrame(rows, VEC).repartition(3), chunk_bytes=chunk_bytes, tile=tile)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_near(rows)


def test_near_vectors_of_an_empty_table(spark):
    assert tiles.near(spark.createDataFrame([], VEC)).count() == 0


def test_quantisation_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    for dims in (1, 3, 64, 1500):
        u = tiles.unit(rng.standard_normal((60, dims)) * 10.0 ** rng.integers(-12, 12, (60, 1)))
        code, scale, length, error = tiles.quantise(u)
        about = (code.astype(np.int64) @ code.T.astype(np.int64)) * np.outer(scale, scale)
        bound = error[:, None] + length[:, None] * error[None, :]
        assert (np.abs(about - u @ u.T) <= bound + tiles.SLACK).all()
        i, j = tiles.possible((code.astype(np.float64) @ code.T).astype(np.float64), slice(0, 60), slice(0, 60), scale, length, error, 0.98)
        maybe = set(zip(i.tolist(), j.tolist()))
        assert {(a, b) for a, b in np.argwhere(u @ u.T >= 0.98).tolist()} <= maybe
        if dims >= 64:
            assert len(maybe) == 60  # nothing but each vector with itself


# ---- whitening

def brute_whiten(rows, most=16):
    used = [(i, (np.floor(64 * np.array(v)) + 1_000_000).astype(np.int64)) for i, v in rows
            if v and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array(sorted({tuple(v) for _, v in used}))
    n, s = len(x), x.sum(axis=0)
    centred = (x * n - s) / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    order = order[values[order] > 1e-12 * values.max()]
    return used, n, s, values[order], parts[:, order], values.sum()


@pytest.mark.parametrize("kind", ["plain", "flat", "equal"])
def test_whitening_matches_a_dense_eigensolver(spark, kind):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((70, 6)) * [5, 4, 3, 2, 1, 0.5]
    if kind == "flat":  # rank four
        x[:, 4], x[:, 5] = 0.25, np.floor(64 * x[:, 0]) / 64
        x[:, 0] = x[:, 5]
    if kind == "equal":  # repeated eigenvalues: a cross of axes
        x = np.concatenate([s * 2 * np.eye(6) for s in (1, -1)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3, x[3].tolist()), (None, x[4].tolist()), (70, None), (71, []), (72, [1.0] * 5),
                                                          (73, [None] + [1.0] * 5), (74, [float("nan")] * 6), (75, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, component double").repartition(3)
    got = collections.defaultdict(list)
    for r in sorted(whitening.whiten(df).collect(), key=lambda r: r.component):
        got[(r.vec_id, r.deviation)].append(r)
    used, n, s, values, parts, trace = brute_whiten(rows)
    assert collections.Counter(i for i, _ in used) == collections.Counter(
        {k: sum(len(rs) for (i, _), rs in got.items() if i == k) // len(values) for k in {i for i, _ in used}})
    for i, v in used:
        deviation = int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s)))
        rs = got[(i, deviation)][: len(values)] if i not in (3,) else got[(i, deviation)][::2]
        assert [r.component for r in rs] == list(range(1, len(values) + 1))
        assert all(r.n == n and r.identity_error < 1e-9 for r in rs)
        assert np.allclose([r.explained for r in rs], values / trace, rtol=1e-10)
        white, mine = (v - s / n) @ parts / np.sqrt(values), np.array([r.whitened for r in rs])
        if kind == "equal":  # any basis of the space
            assert np.isclose(np.linalg.norm(mine), np.linalg.norm(white))
        else:
            assert np.allclose(np.abs(mine), np.abs(white), atol=1e-8)


def test_whitening_without_spread_or_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).count() == 0
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], kind)).orderBy("vec_id").collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9), round(r.explained, 9)) for r in two] == [
        (1, 1, 2, 4096, 1.0, 1.0), (2, 1, 2, 4096, 1.0, 1.0)]


def test_deviation_is_exact_and_null_beyond_a_long():
    centre = whitening.Centre(3, [10, -2])
    assert centre.deviation(np.array([[4, -1], [3, 0]])) == [(12 - 10) ** 2 + (-3 + 2) ** 2, 1 + 4]
    big = whitening.Centre(1 << 30, [0, 0])
    assert big.deviation(np.array([[2, 1], [1 << 20, 0]])) == [5 << 60, None]


# ---- spelling variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_spelling(rows):
    n = collections.Counter()
    for i, t in rows:
        for w in RUN.findall(t or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w if h % 97 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(4)
    stems = ["".join(rng.choice(list("abcdeéÉß÷"), k)) for k in rng.integers(4, 9, 40)] + ["aabbc", "abcab", "cabab", "bacba"]
    words = list(stems)
    for w in stems:  # one and two edits away, and anagrams
        for _ in range(4):
            k = int(rng.integers(len(w)))
            words += [w[:k] + w[k + 1:], w[:k] + "x" + w[k:], w[:k] + "é" + w[k + 1:], "".join(rng.permutation(list(w)))]
    weight = 1 / np.arange(1, len(words) + 1)
    rows = [(int(i), "1 ".join(rng.choice(words, 60, p=weight / weight.sum()))) for i in range(90)]
    return rows + [(90, None), (91, ""), (92, "日本 123"), (None, "Stressed STRESSED stressed stresse"), rows[0], rows[0],
                   (93, "a" * 3000 + " " + "a" * 2999 + "b" + " " + "a" * 3001)] + [(94 + i, "a" * 3000 + "," + "a" * 3001 + "," + "a" * 2999 + "b") for i in range(3)]


@pytest.mark.parametrize("part, sample, leaf", [(50_000, 200_000, 32), (20, 200_000, 3), (3, 60, 2)])
def test_spelling_matches_brute_force(spark, texts, part, sample, leaf):
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in texts], "doc_id long, text string, n int, word string").repartition(3)
    got = spelling.group(df, part=part, sample=sample, leaf=leaf)
    want = brute_spelling(texts)
    assert sorted(tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in got.collect()) == want
    assert any(r[3] and r[5] != r[3] for r in want) and sum(r[2] for r in want) > 200


def test_spelling_of_an_empty_table(spark):
    assert spelling.group(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_upper_tree_reaches_the_leaves_of_all_neighbours():
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abcde"), 7)) for _ in range(500)})
    points = spelling.counts(spelling.letters(words, 7))
    tree = spelling.Upper(points[::5], 4)
    place, (who, leaf) = tree.place(points), tree.reach(points, 1)
    reached = set(zip(who.tolist(), leaf.tolist()))
    assert tree.leaves > 10 and len(reached) < 0.8 * len(words) * tree.leaves
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if one_edit(a, b):
                assert (i, int(place[j])) in reached
