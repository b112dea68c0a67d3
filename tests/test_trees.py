"""Histogram trees against an exhaustive search, and boosting and forest runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.operators.ml import train as tr, trees
from salescast.sources import io

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (1500, 3)).astype(float)
    y = 3 * x[:, 0] + (x[:, 1] > 5) * x[:, 2] + rng.standard_normal(1500)
    data = [(*map(float, r), float(t), i % 5 == 0) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "a double, b double, c double, sales double, held boolean").repartition(4).cache()


def exhaustive(x, y, depth, min_rows, l1=0.0, l2=0.0):
    """Predictions of a tree whose splits are the best of all thresholds."""
    score = lambda t: max(abs(t.sum()) - l1, 0) ** 2 / (len(t) + l2)
    best = (1e-9, None)
    if depth:
        for k in range(x.shape[1]):
            for cut in np.unique(x[:, k])[:-1]:
                left = x[:, k] <= cut
                if min(left.sum(), (~left).sum()) >= min_rows:
                    gain = score(y[left]) + score(y[~left]) - score(y)
                    if gain > best[0] + 1e-9:
                        best = (gain, left)
    if best[1] is None:
        return np.full(len(y), np.sign(y.sum()) * max(abs(y.sum()) - l1, 0) / (len(y) + l2))
    out = np.empty(len(y))
    for side in (best[1], ~best[1]):
        out[side] = exhaustive(x[side], y[side], depth - 1, min_rows, l1, l2)
    return out


def predictions(model, df):
    return np.array([r.prediction for r in model.transform(df).orderBy(*COLS, "sales").collect()])


@pytest.mark.parametrize("small", [50, 300, 10_000])
def test_one_tree_equals_an_exhaustive_search_wherever_it_is_grown(spark, rows, small, monkeypatch):
    monkeypatch.setattr(trees, "SMALL", small)
    monkeypatch.setattr(trees, "LARGE", small)
    monkeypatch.setattr(trees, "BLOCK", 100)
    model = trees.boost(rows, COLS, "sales", trees.Params(depth=5, min_rows=15, l1=2.0, l2=1.5), 1)
    data = np.array([(r.a, r.b, r.c, r.sales) for r in rows.orderBy(*COLS, "sales").collect()])
    y = data[:, 3]
    assert np.allclose(predictions(model, rows), y.mean() + exhaustive(data[:, :3], y - y.mean(), 5, 15, 2.0, 1.5), atol=1e-9)


def test_leaf_budget_splits_the_largest_gains_first(rows):
    full = trees.boost(rows, COLS, "sales", trees.Params(depth=6, min_rows=10), 1)
    for most in (2, 9, 20):
        model = trees.boost(rows, COLS, "sales", trees.Params(depth=6, min_rows=10, max_leaves=most), 1)
        assert model.leaves == [most] and max(full.leaves) > 20
    # leaf by leaf on plain nodes: the budgeted tree keeps the splits of largest gain that can be reached
    nodes = {1: (0, 3, 9.0, 100, 1.0), 2: (1, 1, 5.0, 50, 1.0), 3: (2, 1, 1.0, 50, 1.0), 4: (0, 1, 8.0, 20, 1.0)}
    nodes |= {k: (-1, 0, 0.0, 10, 1.0) for k in (5, 6, 7, 8, 9)}
    tree = trees.budgeted(nodes, trees.Params(depth=3, max_leaves=4))
    assert [k for k in range(16) if tree.feature[k] >= 0] == [1, 2, 4]


def test_small_nodes_are_grown_without_a_pass_a_level_and_the_same_to_the_bit(rows, monkeypatch):
    passes, passed = [], trees._passed

    def counted(*args):
        passes.append(args[2])
        return passed(*args)

    monkeypatch.setattr(trees, "_passed", counted)
    monkeypatch.setattr(trees, "BLOCK", 100)
    for p in (trees.Params(depth=6, min_rows=5, max_leaves=12, step=0.3, rows=0.8, columns=0.7, l1=0.1, l2=0.1),
              trees.Params(depth=6, min_rows=5, step=0.3, bootstrap=True)):
        passes.clear()
        model = trees.boost(rows, COLS, "sales", p, 4, validation=F.col("held"))
        assert [passes.count(k) for k in range(1, 5)] == [1] * 4  # a pass a round, for its root
        for alone, most in ((400, 512), (1, 512), (10_000, 3)):
            with monkeypatch.context() as other:
                other.setattr(trees, "ALONE", alone)
                other.setattr(trees, "PASS", most)
                again = trees.boost(rows, COLS, "sales", p, 4, validation=F.col("held"))
            assert again.curve == model.curve
            assert all(np.array_equal(a, b) for t, u in zip(model.tables, again.tables) for a, b in zip(t, u))


def test_nodes_that_lose_few_rows_a_split_leave_the_passes_early(spark, monkeypatch):
    data = [(float(k + 1), float(3 ** k)) for k in range(7) for _ in range(20)] + [(0.0, 0.1 * (i % 3)) for i in range(1860)]
    df, passes, passed = spark.createDataFrame(data, "a double, sales double").repartition(4).cache(), [], trees._passed
    monkeypatch.setattr(trees, "_passed", lambda *a: passes.append(a[2]) or passed(*a))
    found = []
    for alone in (1200, 1):  # each split takes 20 of 2,000 rows off
        with monkeypatch.context() as other:
            other.setattr(trees, "ALONE", alone)
            passes.clear()
            model = trees.boost(df, ["a"], "sales", trees.Params(depth=6, min_rows=5, step=0.5), 3)
        found.append(model.tables)
        assert alone == 1 or [passes.count(k) for k in (1, 2, 3)] == [1, 1, 1]
    assert all(np.array_equal(a, b) for t, u in zip(*found) for a, b in zip(t, u))


def plain(x, r, w, node, p, cols, sizes):
    """{node: (feature, bin, n, total)}, each from sums over all of its rows."""
    own = [sizes[c] for c in cols]
    h = trees._opened_out(np.concatenate(trees._summed(np.zeros(len(r), np.int64), 1, x.T[cols], w * r, w, own)), 1, own)
    feature, cut, _, n, total, _ = (q[0] for q in trees.best_splits(h, cols, own, p))
    if feature < 0 or node.bit_length() > p.depth:
        return {node: (-1, 0, n, total)}
    right = x[:, feature] > cut
    return {node: (feature, cut, n, total)} | {k: v for a, c in ((~right, 2 * node), (right, 2 * node + 1)) for k, v in plain(x[a], r[a], w[a], c, p, cols, sizes).items()}


@pytest.mark.parametrize("whole", [True, False])
def test_a_subtree_is_the_same_to_the_bit_however_its_rows_are_summed(whole, monkeypatch):
    rng, sizes = np.random.default_rng(11), [12, 2, 40, 7, 1]
    x = np.stack([rng.integers(0, k, 4000) for k in sizes], axis=1).astype(np.uint8)
    r = np.rint(9 * rng.random(4000)) + 3 * (x[:, 2] > 11) + (0 if whole else 0.1)
    w, cols, summed, real = rng.integers(1, 4, 4000).astype(float), np.array([0, 2, 3, 4]), [], trees._summed
    for p, root in ((trees.Params(depth=9, min_rows=8), 1), (trees.Params(depth=5, min_rows=1, l1=0.5, l2=1.0), 3), (trees.Params(depth=2), 9)):
        want = plain(x, r, w, root, p, cols, sizes)
        for cached, most, group in ((1 << 14, 512, 64 << 20), (100, 3, 64 << 20), (500, 512, 16 * 60 * 5)):
            with monkeypatch.context() as other:
                for name, v in (("CACHED", cached), ("PASS", most), ("GROUP_BYTES", group)):
                    other.setattr(trees, name, v)
                other.setattr(trees, "_summed", lambda *a: summed.append(len(a[0]) if len(a[-1]) > 1 else 0) or real(*a))
                summed.clear()
                got = trees.grow_rest(x, r, w, root, p, cols, sizes)
            assert {k: (f, c if f >= 0 else 0, n, t) for k, f, c, _, n, t, _ in got} == want and len(got) == len(want)
            if whole and group > 1 << 20 and p.depth == 9:  # of two siblings one is summed
                assert sum(summed) < 4000 + 0.6 * 4000 * 8


def test_runs_are_given_up_when_asked(rows):
    for make in (trees.boost, trees.forest):
        with pytest.raises(trees.GivenUp):
            make(rows, COLS, "sales", trees.Params(depth=3), 5, stop=lambda: True)


def test_a_longer_forest_takes_only_whole_groups_of_a_shorter_one(rows, tmpdir_path):
    p, folder = trees.Params(depth=4, min_rows=10, bootstrap=True), f"{tmpdir_path}/forest"
    trees.forest(rows, COLS, "sales", p, 3, folder=folder, group=2)
    more = trees.forest(rows, COLS, "sales", p, 6, folder=folder, group=2)
    assert len(more.tables) == 6 and np.array_equal(predictions(more, rows), predictions(trees.forest(rows, COLS, "sales", p, 6, group=2), rows))


def test_patience_outlives_a_pause_and_cuts_back():
    stop = trees.Patience(50)
    curve = [10 - 0.1 * k for k in range(30)] + [9.0] * 20 + [6.5 - 0.1 * k for k in range(10)] + [8.0] * 60
    taken = next(k for k, e in enumerate(curve) if stop.add(e)) + 1
    assert stop.best == 59 and taken == 60 + 49 and stop.curve == curve[:taken]
    never = trees.Patience(50)
    assert not any(never.add(1.0 / (k + 1)) for k in range(500)) and never.best == 499


def test_boosting_stops_by_patience_at_its_best_round(rows):
    p = trees.Params(depth=3, min_rows=5, step=0.3, rows=0.7, columns=0.7)
    model = trees.boost(rows, COLS, "sales", p, 400, patience=8, validation=F.col("held"))
    assert model.rounds < 400 and len(model.tables) == model.best_round == int(np.argmin(model.curve))
    assert len(model.curve) - model.best_round >= 8 and min(model.curve) < 0.3 * model.curve[0]
    held = rows.where("held")
    error = model.transform(held).select(F.sqrt(F.avg((F.col("prediction") - F.col("sales")) ** 2))).first()[0]
    assert abs(error - min(model.curve)) < 1e-9
    whole = trees.boost(rows, COLS, "sales", p, 12, patience=8, validation=F.col("held"))
    assert whole.rounds == 12 and len(whole.curve) == 13 and whole.curve == pytest.approx(model.curve[:13])


def test_a_broken_boosting_run_goes_on_where_it_was(rows, tmpdir_path):
    p = trees.Params(depth=3, min_rows=5, step=0.2, rows=0.8, columns=0.7)

    class Lost(Exception):
        pass

    def fail(k):
        if k == 8:
            raise Lost

    go = lambda folder, **more: trees.boost(rows, COLS, "sales", p, 14, patience=9, validation=F.col("held"), kept=4, folder=folder, **more)
    with pytest.raises(Lost):
        go(f"{tmpdir_path}/run", on_block=fail)
    blocks = []
    again = go(f"{tmpdir_path}/run", on_block=blocks.append)
    assert blocks == [12]  # blocks 4 and 8 were read, not grown again
    whole = go(f"{tmpdir_path}/other")
    assert again.rounds == whole.rounds and again.curve == pytest.approx(whole.curve, rel=1e-12)


def test_forest_is_the_same_whatever_its_groups(spark, rows, tmpdir_path):
    p = trees.Params(depth=6, min_rows=10, bootstrap=True)
    folder = f"{tmpdir_path}/forest"
    two = trees.forest(rows, COLS, "sales", p, 7, folder=folder, group=2)
    five = trees.forest(rows, COLS, "sales", p, 7, folder=folder, group=5)
    assert np.allclose(predictions(two, rows), predictions(five, rows), atol=1e-9)
    assert len({t[0].tobytes() + t[1].tobytes() for t in two.tables}) == 7  # each tree has a sample of its own
    before = spark.read.parquet(f"{folder}/groups-2/*").inputFiles()
    trees.forest(rows, COLS, "sales", p, 7, folder=folder, group=2)
    assert spark.read.parquet(f"{folder}/groups-2/*").inputFiles() == before  # finished groups are not grown again
    single = two.transform(rows).select(F.avg((F.col("prediction") - F.col("sales")) ** 2)).first()[0]
    assert single < 0.1 * rows.select(F.var_pop("sales")).first()[0]
    assert abs(sum(r.importance for r in tr.importance(spark, two, COLS).collect()) - 1) < 1e-9


def test_ensembles_are_saved_and_loaded(rows, tmpdir_path):
    model = trees.boost(rows, COLS, "sales", trees.Params(depth=4, min_rows=5, step=0.5), 5, validation=F.col("held"))
    io.save_model(model, f"{tmpdir_path}/m")
    kept = io.load_model(f"{tmpdir_path}/m")
    assert np.array_equal(predictions(model, rows), predictions(kept, rows)) and kept.curve == model.curve


def test_ensembles_of_nothing_constants_and_missing_values(spark):
    kind = "a double, b double, c double, sales double"
    empty = spark.createDataFrame([], kind)
    one = spark.createDataFrame([(1.0, None, float("nan"), 4.0)] * 30 + [(2.0, 1.0, 1.0, None)], kind)
    p = trees.Params(depth=3, min_rows=1)
    for make in (lambda d: trees.boost(d, COLS, "sales", p, 3), lambda d: trees.forest(d, COLS, "sales", p, 3)):
        assert predictions(make(empty), one).tolist() == [0.0] * 31
        assert np.allclose(predictions(make(one), one), 4.0)


def test_a_round_takes_one_job_a_level_and_shuffles_no_row(spark, rows, monkeypatch):
    monkeypatch.setattr(trees, "BLOCK", 100)
    monkeypatch.setattr(trees, "SMALL", 50)
    monkeypatch.setattr(trees, "LARGE", 50)
    p, passed = trees.Params(depth=4, min_rows=5, step=0.5, rows=0.8), []
    real = trees._passed
    monkeypatch.setattr(trees, "_passed", lambda *a: passed.append(a[0].getNumPartitions()) or real(*a))
    sc = spark.sparkContext
    sc.setJobGroup("rounds", "boosting")
    model = trees.boost(rows, COLS, "sales", p, 6, validation=F.col("held"), kept=100)
    few = len(sc.statusTracker().getJobIdsForGroup("rounds"))
    sc.setJobGroup("more", "boosting")
    longer = trees.boost(rows, COLS, "sales", p, 16, validation=F.col("held"), kept=100)
    more = len(sc.statusTracker().getJobIdsForGroup("more"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert more - few <= 10 * p.depth and set(passed) == {sc.defaultParallelism}
    assert longer.curve[:7] == pytest.approx(model.curve, rel=1e-12)


def test_workers_of_a_pass_leave_nothing_to_collect(spark, rows):
    import gc
    trees.boost(rows, COLS, "sales", trees.Params(depth=3, min_rows=5), 2)
    sc = spark.sparkContext
    frozen = sc.parallelize(range(4 * sc.defaultParallelism), sc.defaultParallelism).mapPartitions(lambda _: [gc.get_freeze_count()]).collect()
    assert max(frozen) > 0


@pytest.mark.parametrize("depth", [0, 1, 4])
def test_nodes_by_column_are_the_leaves(depth):
    rng = np.random.default_rng(9)
    x, tree = rng.integers(0, 256, (500, 6)).astype(np.uint8), trees.Tree.empty(0)
    x[:3] = 255
    for k in range(1, 1 << depth):
        if k == 1 or (tree.feature[k // 2] >= 0 and k != 5):  # one branch ends early
            tree.split(k, int(rng.integers(6)), int(rng.integers(40, 200)))
    assert np.array_equal(trees._nodes(tree, np.ascontiguousarray(x.T)), tree.leaf(x))


def test_nodes_left_out_by_the_leaf_budget_are_never_split(rows, monkeypatch):
    grow = lambda most: trees.boost(rows, COLS, "sales", trees.Params(depth=6, min_rows=10, max_leaves=most), 3)
    pruned = {most: predictions(grow(most), rows) for most in (2, 9, 20, 64)}
    monkeypatch.setattr(trees, "_wanted", lambda nodes, level, p: [k for k in level if nodes[k][0] >= 0])
    for most, found in pruned.items():
        assert np.array_equal(found, predictions(grow(most), rows))


def test_histograms_added_up_by_tasks_and_in_parts_give_the_same_model(rows, monkeypatch):
    monkeypatch.setattr(trees, "BLOCK", 100)
    grow = lambda: predictions(trees.boost(rows, COLS, "sales", trees.Params(depth=5, min_rows=5, step=0.5), 3), rows)
    plain = grow()
    monkeypatch.setattr(trees, "DRIVER_BYTES", 0)
    monkeypatch.setattr(trees, "PASS", 3)
    assert np.allclose(plain, grow(), atol=1e-9)


def test_models_are_fitted_side_by_side_and_once(monkeypatch):
    import threading

    from salescast.plans.context import Context
    ctx, fits, meet = Context(None, ""), [], threading.Barrier(3, timeout=30)
    ctx.__dict__["model_frames"] = (None, None, None)

    def fit(frame, config):
        meet.wait()  # passes only when three are at it
        fits.append(config["kind"])
        return config["kind"], 0.0

    monkeypatch.setattr(tr, "fit", fit)
    ctx.fit_all(["GBT", "ElasticNet", "RandomForest"])
    ctx.fit_all(["GBT", "ElasticNet", "RandomForest"])
    assert sorted(fits) == ["boost", "forest", "lr"] and ctx.fitted("GBT")[0] == "boost"
