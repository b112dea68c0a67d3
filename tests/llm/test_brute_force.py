"""Fitted models against plain versions that share no code with them."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.llm import decontaminate, langid, pst, quality
from salescast.llm import text as tx
from tests.llm.test_operators import SPACED, docs, low  # noqa: F401


# ---- scoring

def plain_tree(texts, depth, least, divergence):
    """counts[context][symbol] of all contexts up to ``depth``, and the retained ones."""
    counts = collections.defaultdict(collections.Counter)
    for stream in texts:
        for i in range(depth, len(stream)):
            for k in range(depth + 1):
                counts[stream[i - k: i]][stream[i]] += 1
    kept = {b""}
    for context, after in counts.items():
        tot = sum(after.values())
        if not context or tot < least:
            continue
        up = counts[context[1:]]
        utot = sum(up.values())
        gain = sum(n * math.log(n / tot / (up[s] / utot)) for s, n in after.items())
        df = max(1, len(up) - 1)
        if 2 * gain > df + 3 * math.sqrt(2 * df) and gain >= divergence * tot:
            kept |= {context[j:] for j in range(len(context))}
    return counts, kept


def plain_score(stream, counts, kept, depth):
    out = 0.0
    for i in range(depth, len(stream)):
        after = counts[b""]
        p = (after[stream[i]] + 1) / (sum(after.values()) + 256)
        for k in range(1, depth + 1):
            context = stream[i - k: i]
            if context not in kept:
                break
            after = counts[context]
            p = (after[stream[i]] + len(after) * p) / (sum(after.values()) + len(after))
        out += math.log10(p)
    return out


def stream_of(text, depth):
    return b"\n" * depth + "".join(w + " " for w in SPACED.findall(low(text))).encode() + b"\n"


@pytest.mark.parametrize("depth,least,divergence,hot,frequent", [
    (5, 2, 0.002, pst.HOT, pst.FREQUENT), (5, 2, 0.002, 2.0, 2.0), (3, 5, 0.05, 1e-3, 1e-2)])
def test_suffix_tree_equals_a_dictionary_version(spark, docs, depth, least, divergence, hot, frequent):  # noqa: F811
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counts, kept = plain_tree([stream_of(t, depth) for d, t in rows if not held(d)], depth, least, divergence)
    assert 1 < len(kept) < len(counts)
    want = sorted((str(d), plain_score(stream_of(t, depth), counts, kept, depth)) for d, t in rows)
    got = sorted((str(r.doc_id), r.score) for r in pst.score(
        docs, tx.crc_fold(F.col("doc_id"), 7) != 2, depth=depth, least=least, divergence=divergence, hot=hot, frequent=frequent).collect())
    assert [d for d, _ in got] == [d for d, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], rel=1e-9)


def test_words_of_one_hash_keep_their_own_counts(spark, docs, monkeypatch):  # noqa: F811
    """Words are joined by a hash; with all hashes equal, counts stay right."""
    want = sorted((str(r.doc_id), r.n_known, r.base_score) for r in pst.score(docs, F.lit(True), frequent=2.0).collect())
    monkeypatch.setattr(pst, "_key", lambda word, gram: F.coalesce(gram, F.when(word.isNotNull(), F.lit(-1))))
    got = sorted((str(r.doc_id), r.n_known, r.base_score) for r in pst.score(docs, F.lit(True), frequent=2.0).collect())
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want], rel=1e-9)


def test_table_and_pair_counts_equal_dictionaries():
    rng = np.random.default_rng(5)
    for size in (0, 1, 7, 4000):
        keys = np.unique(rng.integers(0, 2**48, size, dtype=np.uint64))
        values = rng.random(len(keys))
        held = dict(zip(keys.tolist(), values.tolist()))
        wanted = np.concatenate([keys, rng.integers(0, 2**48, 500, dtype=np.uint64), keys[:3]])
        got = pst.Table(keys, values).look_up(wanted)
        assert [None if np.isnan(x) else x for x in got] == [held.get(k) for k in wanted.tolist()]
    for top in (40, 2**20):  # within and beyond the rows that fit beside 48 bits
        of, grams = rng.integers(0, top, 3000), rng.integers(0, 9, 3000, dtype=np.uint64) << np.uint64(40)
        of[:2] = [0, top - 1]
        got = pst.pair_counts(of, grams, 5)
        want = collections.Counter(zip(of.tolist(), grams.tolist()))
        assert list(zip(*(x.tolist() for x in got))) == sorted((*pair, n) for pair, n in want.items())


# ---- language

def test_posteriors_and_expected_transitions_are_the_gradient_of_the_likelihood():
    rng = np.random.default_rng(8)
    scores, move, first = rng.normal(size=(7, 3)), rng.normal(size=(3, 3)), np.array([0, 3, 4])

    def log_all(scores, move):
        """Log of the sum over all label sequences, chain by chain."""
        out = 0.0
        for a, z in ((0, 3), (3, 4), (4, 7)):
            paths = itertools.product(range(3), repeat=z - a)
            out += np.logaddexp.reduce([sum(scores[a + i, y] for i, y in enumerate(p)) + sum(move[x, y] for x, y in zip(p, p[1:])) for p in paths])
        return out

    def slope(of, x):
        out = np.zeros_like(x)
        for i in np.ndindex(*x.shape):
            d = np.zeros_like(x)
            d[i] = 1e-5
            out[i] = (of(x + d) - of(x - d)) / 2e-5
        return out

    post, expected = langid.forward_backward(scores, move, first, pairs=True)
    assert np.allclose(post, slope(lambda s: log_all(s, move), scores), atol=1e-7)
    assert np.allclose(expected, slope(lambda m: log_all(scores, m), move), atol=1e-7)


def test_language_sample_is_bounded_by_rows(spark, monkeypatch):
    """An id shared by many rows, repeated rows and long texts don't swell the sample."""
    rows = [(7, f"hot words {i}", "en") for i in range(300)] + [(8, "twice", "en")] * 40 + [(9, "lang " * 80, "en"), (10, None, "en"), (None, "no id", "en")]
    rows += [(20, "nur lang " * 80, "de"), (21, "kurz", "de")] + [(100 + i, f"w{i}", f"l{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    monkeypatch.setattr(langid, "LONG_TEXT", 100)
    seen = {}
    monkeypatch.setattr(langid, "train", lambda texts, labels, languages, *_: seen.update(rows=list(zip(texts, [languages[y] for y in labels]))))
    langid.fit(docs, F.lit(True), sample=6)
    by = collections.defaultdict(list)
    for t, l in seen["rows"]:
        by[l].append(t)
    assert len(by) == 202 and len(by["en"]) == 6 and not any(t.startswith("lang") for t in by["en"])
    assert sorted(by["de"], key=len) == ["kurz", "nur lang " * 80]
    langid.fit(docs, F.lit(True), sample=1000)
    assert sum(l == "en" for _, l in seen["rows"]) == 300 + 1 + 1


# ---- quality

def plain_risk(w, x, positive, prior):
    z = x @ w
    plus, minus_p, minus_u = (np.logaddexp(0, -z[positive]).mean(), np.logaddexp(0, z[positive]).mean(), np.logaddexp(0, z).mean())
    return prior * plus + max(0.0, minus_u - prior * minus_p) + quality.RIDGE / 2 * w @ w, minus_u - prior * minus_p


@pytest.mark.parametrize("prior,clipped", [(0.3, False), (0.97, True)])
def test_risk_is_minimised_on_both_branches(spark, prior, clipped):
    rng = np.random.default_rng(4)
    n = 400
    good = rng.random(n) < 0.4
    x = np.stack([np.ones(n), rng.normal(size=n) + 1.5 * good, rng.normal(size=n)], axis=1)
    positive = good & (rng.random(n) < 0.5)
    rows = spark.createDataFrame([(v.tolist(), bool(p)) for v, p in zip(x, positive)], "x array<double>, positive boolean").repartition(3)
    w = quality.newton(rows, np.zeros(3), np.ones(3), float(positive.sum()), float(n), prior)
    risk, rest = plain_risk(w, x, positive, prior)
    assert (rest <= 1e-6) == clipped
    around = [plain_risk(w + d, x, positive, prior)[0] for d in rng.normal(scale=0.05, size=(200, 3))]
    assert risk <= plain_risk(np.zeros(3), x, positive, prior)[0]
    if not clipped:
        assert risk <= min(around) + 1e-4


def test_class_prior_equals_a_plain_scan(spark):
    rng = np.random.default_rng(9)
    score, positive = rng.random(500), rng.random(500) < 0.2
    score[positive] = np.sqrt(score[positive])
    n_pos, n_un = int(positive.sum()), 500
    rows = spark.createDataFrame([(float(s), bool(p)) for s, p in zip(score, positive)], "s double, positive boolean")
    slack = sum(math.sqrt(math.log(40) / (2 * k)) for k in (n_pos, n_un))
    found = []
    for cut in np.arange(quality.BINS) / quality.BINS:
        u, p = (score >= cut).mean(), (score[positive] >= cut).mean()
        if p:
            found.append(((u + 1.01 * slack) / p, -cut, u / p))
    assert quality.class_prior(rows, F.col("s"), n_pos, n_un) == pytest.approx(min(found)[2])


# ---- decontamination

def test_a_window_of_all_items_is_dealt_over_blocks(spark):
    shared = " ".join(f"s{i}" for i in range(10))
    items = [(i, f"{shared} tail{i}") for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a {shared} b"), (2, f"{shared} tail3"), (3, "a b"), (4, None)], "doc_id long, text string").repartition(2, "text")
    want = sorted(map(tuple, decontaminate.digest(*decontaminate.find(docs, bench)).collect()))
    held, real = [], decontaminate.Block.__init__
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(decontaminate.Block, "__init__", lambda self, rows: held.append(len(rows)) or real(self, rows))
        got = sorted(map(tuple, decontaminate.digest(*decontaminate.find(docs, bench, block_windows=10)).collect()))
    assert got == want and [r[3] for r in want] == [40, 40, 0, 0] and [r[2] for r in want] == [10, 11, 0, 0]
    assert sum(held) == 80 and max(held) < 30
