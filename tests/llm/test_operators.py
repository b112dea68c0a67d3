"""The training-data operators against brute force, and their edge cases."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from salescast.llm import decontaminate, langid, licenses, mixing, pst, quality, rules, simhash, token_counts, toxicity
from salescast.llm import text as tx
from salescast.llm.components import components

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in tx.ASCII_UPPER})

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words string"


def low(t):
    return (t or "").translate(UPPER)


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, and
    extra columns with the names of results."""
    rng = np.random.default_rng(3)
    vocab = ["The", "quick", "ÉTÉ", "naïve", "x1", "brown", "fox", "of", "and", "über", "a,b", "###", "THE", "日本"]
    text = lambda n: " ".join(rng.choice(vocab, n))
    rows = [(i, text(int(rng.integers(1, 90))), ["en", "de", None][i % 3], f"s{i % 4}" if i % 5 else None, 5, 0.5, "x") for i in range(60)]
    rows += [(60, None, "en", "s1", None, None, None), (61, "", None, None, 0, None, None), (62, " \t\n ", "en", "s1", 4, 0.1, "y"),
             (None, text(30), "en", "s2", 1, 0.1, None), (None, None, None, None, None, None, None),
             (63, text(9000), "en", "s0", 1, None, None), (64, "a", "en", "s0", 1, None, None)]
    rows += [rows[5], rows[5], (70, rows[7][1], "en", "s3", 1, 0.0, "z"), (71, rows[7][1] + " and", "en", "s3", 1, 0.0, "z")]
    return spark.createDataFrame(rows, DOC).repartition(3).cache()


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


# ---- decontamination

def brute_leaks(docs, items, n=10):
    out = []
    wins = collections.defaultdict(set)
    for item, t in items:
        w = PLAIN.findall(low(t))
        if item is None or not w:
            continue
        k = min(n, len(w))
        for i in range(len(w) - k + 1):
            wins[tuple(w[i:i + k])].add(str(item))
    for d, t in docs:
        w, hit, seen = PLAIN.findall(low(t)), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if got := wins.get(tuple(w[i:i + k])):
                    hit |= set(range(i, i + k))
                    seen |= got
        out.append((d, len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("block", [1 << 18, 7])
def test_decontaminate_equals_brute_force(spark, docs, block):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    long = next(t for d, t in rows if d == 63)
    some = next(t for d, t in rows if d == 8)
    items = [(1, " ".join(SPACED.findall(long)[40:70])), (10, "Brown, FOX"), (2, some), (2, some), (3, ""), (4, None), (None, "quick quick"), (5, "zz zz")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found, name = decontaminate.find(docs, bench, block_windows=block)
    assert set(docs.columns) < set(found.columns)
    assert collected(decontaminate.digest(found, name)) == brute_leaks(rows, items)


def test_decontaminate_spans_and_cleaning(spark):
    d = spark.createDataFrame([(1, "É one two, three. four"), (2, "clean"), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "TWO three")], "item_id long, text string")
    found, name = decontaminate.find(d, b)
    span = found.where("doc_id = 1").select(F.col(name)["spans"]).first()[0][0]
    assert "É one two, three. four"[span.char_start:span.char_end] == "two, three" and (span.start, span.end) == (2, 4)
    assert collected(decontaminate.clean(found, name, mode="spans")) == [(1, "É one . four"), (2, "clean"), (3, None)]
    assert {r.doc_id for r in decontaminate.clean(found, name).collect()} == {2, 3}
    empty = decontaminate.find(d, b.limit(0))
    assert all(not r.contaminated for r in decontaminate.digest(*empty).collect())
    assert decontaminate.digest(*decontaminate.find(d.limit(0), b)).count() == 0


# ---- SimHash

def brute_simhash(rows):
    fps = []
    for _, t in rows:
        w = SPACED.findall(low(t))
        sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_simhash_equals_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert collected(simhash.cluster(docs)) == brute_simhash(rows)


@pytest.mark.parametrize("most,radius", [(64, 2), (2, 2), (2, 1)])
def test_links_connect_what_all_pairs_connect(spark, most, radius):
    rng = np.random.default_rng(1)
    seeds = [int(x) for x in rng.integers(-2**62, 2**62, 30)]
    fps = set(seeds)
    for s in seeds[:6]:  # dense clouds around a few
        for _ in range(25):
            x = s
            for b in rng.choice(63, int(rng.integers(1, 4)), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    edges = simhash.links(df, radius=radius, most=most)
    bits = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    assert all(bits(*e) <= radius for e in edges.collect())
    root = {x: x for x in fps}
    for _ in fps:
        new = {x: min([root[x], *(root[y] for y in fps if bits(x, y) <= radius)]) for x in fps}
        if new == root:
            break
        root = new
    got = {r.node: r.root for r in components(edges).collect()}
    assert {x: got.get(x, x) for x in fps} == root


def test_pivot_table_never_discards_a_link(spark):
    rng = np.random.default_rng(2)
    pairs = []
    for _ in range(200):
        x = int(rng.integers(-2**62, 2**62))
        y = x ^ (1 << int(rng.integers(62))) ^ (1 << int(rng.integers(62)))
        pairs.append((x, y))
    t = {r.fp: r.d for r in simhash.pivot_table(spark.createDataFrame([(x,) for p in pairs for x in p], "fp long")).collect()}
    assert all(max(abs(a - b) for a, b in zip(t[x], t[y])) <= 2 for x, y in pairs)


def brute_keep_one(rows):
    """(id, text) rows kept: one a component, as ``keep_one`` says."""
    bits = [int(brute_simhash([(0, t)])[0][1], 16) for _, t in rows]
    left, out = set(range(len(rows))), []
    while left:
        todo = [left.pop()]
        group = list(todo)
        while todo:
            x = todo.pop()
            near = [y for y in left if (bits[x] ^ bits[y]).bit_count() <= 2]
            left.difference_update(near)
            todo += near
            group += near
        best = min(group, key=lambda y: (rows[y][0] is None, rows[y][0] or 0, -len(rows[y][1] or ""),
                                         hashlib.sha256((rows[y][1] or "").encode()).hexdigest()))
        out.append((rows[best][0], rows[best][1] or ""))
    return sorted(out, key=str)


def test_keep_one(spark, docs):
    kept = simhash.keep_one(docs)
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == brute_keep_one([(r.doc_id, r.text) for r in docs.collect()])
    assert kept.columns == docs.columns
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_keep_one_of_each_component_where_ids_repeat(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    text = " ".join(rng.choice(words, 300))
    others = [" ".join(rng.choice(words, 40)) for _ in range(4)]
    rows = [(1, others[0]), (1, text), (2, text), (0, text), (0, others[1]), (1, others[0]), (None, others[2]), (None, others[2]),
            (None, text), (None, others[3]), (5, None), (5, ""), (4, " "), (None, None)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _digest string").repartition(3)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str)
    assert got == brute_keep_one(rows) and (1, others[0]) in got and (0, text) in got and len(got) == 6


def test_components_chain_and_empty(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7)], "src long, dst long")
    assert {r.node: r.root for r in components(edges).collect()} == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


# ---- mixing

def brute_mix(rows, share=1.5, epochs=2):
    size = [len(SPACED.findall(t or "")) for _, _, t in rows]
    total = collections.Counter()
    for (_, s, _), n in zip(rows, size):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s.encode() if s else b""))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        rate = (share * sum(size) - sum(epochs * total[s] for s in full)) / max(1e-9, sum(w[s] for s in w if s not in full)) if len(full) < len(w) else 0
        more = {s for s in w if s not in full and w[s] * rate > epochs * total[s]}
        if not more:
            break
        full |= more
    target = {s: epochs * total[s] if s in full else w[s] * rate for s in w}
    out, at = [], collections.Counter()
    for i in sorted(range(len(rows)), key=lambda i: (hashlib.md5(("" if rows[i][0] is None else str(rows[i][0])).encode()).hexdigest(),
                                                     rows[i][0] is not None, rows[i][0] or 0, size[i])):
        d, s, _ = rows[i]
        lead, n, goal = at[s], size[i], math.floor(target[s])
        at[s] += n
        out.append((d, n, total[s], target[s], sum(max(0, min(n, goal - lead - k * total[s])) for k in range(epochs))))
    return out


@pytest.mark.parametrize("slot_rows", [2048, 4])
def test_mix_equals_brute_force(docs, monkeypatch, slot_rows):
    monkeypatch.setattr(mixing, "SLOT_ROWS", slot_rows)
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    occurrences, report = mixing.mix(docs)
    key = lambda r: tuple((x is None, str(x)) for x in (*r[:3], r[4], round(r[3], 6)))
    got, want = sorted(map(tuple, report.collect()), key=key), sorted(brute_mix(rows), key=key)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    seen = occurrences.collect()
    assert [r.position for r in seen] == sorted(r.position for r in seen) and all(0 <= r.position <= 1 for r in seen)
    assert sum(r.taken for r in seen) == sum(r[4] for r in want)


def test_mix_positions_follow_the_schedule(spark):
    rows = [(i, "s0" if i % 2 else "s1", "w " * 10) for i in range(4000)]
    out, _ = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), weights=(1.0, 1.0), slopes=(0.8, -0.8))
    early = collections.Counter(r.source for r in out.where("position < 0.1").collect())
    assert early["s1"] > 5 * early["s0"] > 0  # w(u) = 1 - 0.8 (2u - 1) against 1 + 0.8 (2u - 1)
    kept, _ = mixing.mix(spark.createDataFrame([(1, None, "a b", 7)], "doc_id long, source string, text string, epoch int"), keep=True)
    assert kept.columns == ["doc_id", "source", "text", "epoch", "epoch_", "taken", "position"]
    assert mixing.mix(kept.select("doc_id", "source", "text").limit(0))[1].count() == 0


def test_deal_sums_up_the_written_occurrences(spark, docs, monkeypatch):
    out, report = mixing.deal(docs)
    by = collections.defaultdict(list)
    seen = out.collect()
    for r in seen:
        by[r.row].append(r)
    assert [r.position for r in seen] == sorted(r.position for r in seen)
    rows = report.collect()
    assert len({r.row for r in rows}) == len(rows) == docs.count() and any(not r.taken for r in rows) and any(r.occurrences == 2 for r in rows)
    for r in rows:
        own = by[r.row]
        assert (r.taken, r.occurrences) == (sum(o.taken for o in own), len(own)) and sorted(o.epoch for o in own) == list(range(1, len(own) + 1))
        places = [o.position for o in own]
        assert (r.first_position, r.last_position) == (min(places, default=None), max(places, default=None))
    want = sorted((str(r[0]), r[1], r[2], r[4]) for r in brute_mix([(r.doc_id, r.source, r.text) for r in docs.collect()]))
    assert sorted((str(r.doc_id), r.size, r.source_size, r.taken) for r in rows) == want


def test_op4_runs_the_deal(spark, monkeypatch):
    from salescast.llm import queries
    written, real = {}, mixing.materialize

    def spy(df, *args, **kw):
        written[kw["name"]] = df.columns
        return real(df, *args, **kw)
    monkeypatch.setattr(mixing, "materialize", spy)
    got = queries.op4_mixing(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert {"epoch", "taken", "position"} < set(written["mix-occurrences"])


# ---- scoring

def test_pst_base_counts_and_probabilities(spark, docs):
    got = pst.score(docs, tx.crc_fold(F.col("doc_id"), 7) != 2).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    tok = lambda t: SPACED.findall(low(t)) + ["\n"]
    c = collections.Counter(w for d, t in rows if not held(d) for w in tok(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), held(d), len(tok(t)), sum(c[w] > 0 for w in tok(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tok(t)), 6)) for d, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_pst_distributions_sum_to_one_and_longest_suffix_wins(spark):
    text = " ".join(["abab", "abba", "cab"] * 400)
    grams, _, _ = pst.symbols([text.encode()] * 3, 3)
    key, n = np.unique(grams, return_counts=True)
    table = spark.createDataFrame([(int(k), int(x)) for k, x in zip(key, n)], "gram long, n long")
    tree = pst.grow(pst.retained(table, 3, 1e-4, 0.005).toArrow(), 3)
    assert len(tree.states[2]) > 1  # some contexts are retained
    for context in (b"abc", b"zzz", b" ab", b"\n\n\n", b"bab"):
        base = sum(x << 8 * (3 - i) for i, x in enumerate(context))
        p = 10 ** tree.score(np.array([base | s for s in range(256)], np.uint64))
        assert p.sum() == pytest.approx(1)
    for k in (1, 2, 3):  # suffixes of retained contexts are retained
        assert set((tree.states[k] & np.uint64(256 ** (k - 1) - 1)).tolist()) <= set(tree.states[k - 1].tolist())


def test_pst_prefers_held_out_text_to_the_same_words_reversed(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    held = tx.crc_fold(F.col("doc_id"), 7) == 2
    turned = d.where(held).select((F.col("doc_id") + 10**6).alias("doc_id"), F.reverse("text").alias("text"))
    got = {r.doc_id: r.score for r in pst.score(d.unionByName(turned), (F.col("doc_id") < 10**6) & ~held).collect()}
    pairs = [(got[i - 10**6], s) for i, s in got.items() if i >= 10**6]
    assert len(pairs) > 20 and sum(a > b for a, b in pairs) > 0.9 * len(pairs)
    extra = spark.createDataFrame([(1, "zq xj")], "doc_id long, text string")
    assert pst.score(d.limit(0), F.lit(True)).count() == 0
    assert pst.score(extra, F.lit(False)).first().train_tokens == 0


def test_pst_keeps_a_rare_context_whatever_the_size_of_the_corpus(spark):
    """A context with 40 occurrences diverges as much in 10^9 symbols as alone."""
    def gram(t):
        return int.from_bytes(t, "big")
    rows = [(gram(b"xxx" + bytes([s])), 10**7) for s in range(97, 123)]
    rows += [(gram(b"aqz" + b"b"), 40), (gram(b"aqz" + b"c"), 0)]
    for n_extra in (0, 10**9):
        table = spark.createDataFrame(rows + [(gram(b"yyyy"), n_extra)], "gram long, n long")
        kept = {(r.k, r.ctx) for r in pst.retained(table, 3).collect()}
        assert {(1, gram(b"z"))} <= kept
        tree = pst.grow(pst.retained(table, 3).toArrow(), 3)
        got = {r.gram: r.logp for r in pst.probabilities(table, 3).collect()}
        assert got[gram(b"aqzb")] > -0.1
        assert [got[g] for g in sorted(got)] == pytest.approx(tree.score(np.array(sorted(got), np.uint64)).tolist(), rel=1e-5)


@pytest.mark.parametrize("hot", [2.0, 1e-4, 0.0])
def test_pst_scores_equal_the_tree_in_memory_on_each_path(spark, docs, hot):
    train = tx.crc_fold(F.col("doc_id"), 7) != 2
    texts = [(str(r.doc_id), (r.text or "").encode(), r.t) for r in docs.select("doc_id", "text", F.coalesce(train, F.lit(True)).alias("t")).collect()]
    key, n = np.unique(pst.symbols([t for _, t, own in texts if own], pst.DEPTH)[0], return_counts=True)
    table = spark.createDataFrame([(int(k), int(x)) for k, x in zip(key, n)], "gram long, n long")
    tree = pst.grow(pst.retained(table, pst.DEPTH).toArrow(), pst.DEPTH)
    want = sorted((d, round(float(tree.score(pst.symbols([t], pst.DEPTH)[0]).sum()), 2)) for d, t, _ in texts)
    got = sorted((str(r.doc_id), round(r.score, 2)) for r in pst.score(docs, train, hot=hot).collect())
    assert [d for d, _ in got] == [d for d, _ in want] and [s for _, s in got] == pytest.approx([s for _, s in want], rel=1e-4, abs=0.02)


# ---- licences

def test_base_phrases_equal_brute_force(spark):
    texts = ["MIT license", "the mit  License, and: Apache-License apache license", "mitlicense", "cc by-nc 4.0; cc-by", "emit license", "", None, "é cc by",
             "GNU General\nPublic License gnu general public licenses gnu general public license"]
    got = licenses.digest(*licenses.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    phrases = {tuple(p.split()): label for p, label in licenses.PHRASES.items()}
    for r in got:
        w = PLAIN.findall(low(texts[r.doc_id]))
        at = [(i, label) for i in range(len(w)) for p, label in phrases.items() if tuple(w[i:i + len(p)]) == p]
        first = min((i for i, _ in at), default=None), max((i for i, _ in at), default=None)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(at), *first, ",".join(sorted({x for _, x in at})))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(","))


def test_templates_accept_optional_and_replaceable_text_only():
    auto = licenses.compiled("copy <<beginOptional>>very <<beginOptional>>truly<<endOptional>> freely<<endOptional>> to <<var;name=who;words=1-2>> now")
    ok = ["copy to me now", "copy very freely to you all now", "copy very truly freely to me now"]
    no = ["copy to now", "copy very to me now", "copy truly freely to me now", "copy to a b c now", "copy too me now"]
    for t in ok:
        assert auto.match([w.encode() for w in t.split()], 0) == len(t.split())
    assert all(auto.match([w.encode() for w in t.split()], 0) == -1 for t in no)


def test_automaton_equals_regular_expression():
    template = "a <<beginOptional>>b c<<endOptional>> <<var;name=x;words=0-2>> d"
    auto, pattern = licenses.compiled(template), re.compile("a( b c)?( [a-d]){0,2} d")
    for n in range(1, 7):
        for ws in itertools.product("abcd", repeat=n):
            want = [i for i in range(1, n + 1) if pattern.fullmatch(" ".join(ws[:i]))]
            assert auto.match([w.encode() for w in ws], 0) == (max(want) if want else -1)


def test_full_licence_texts_and_their_changes(spark):
    def plain(label):
        return licenses.MARK.sub(lambda m: "Some One" if m[1].startswith("var") else " ", licenses.TEMPLATES[label])
    rows = [(1, "pre " + plain("mit") + " post"), (2, plain("mit").replace("sublicense", "lease")), (3, plain("bsd-2-clause") + " " + plain("bsd-3-clause"))]
    got = {r.doc_id: r for r in licenses.digest(*licenses.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert "mit" in got[1].labels.split(",") and got[1].score == 1.0
    assert "mit" not in got[2].labels.split(",") and got[2].score < 1.0
    assert got[3].labels == "bsd-2-clause,bsd-3-clause"


MIT = """Copyright (c) 2019 Ada Example

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD3 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.  IN NO EVENT SHALL THE REGENTS OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def test_licences_need_their_whole_mandatory_wording(spark):
    bsd2 = BSD3[:BSD3.index("3. Neither")] + BSD3[BSD3.index("THIS SOFTWARE"):]
    cut = lambda t: t[:t.index("IN NO EVENT")]
    rows = [MIT, MIT.replace("TORT OR OTHERWISE", "TORT"), cut(MIT), BSD3, cut(BSD3), BSD3.replace("EVEN IF ADVISED", "IF ADVISED"), bsd2, cut(bsd2),
            "Licensed under the Apache License, Version 2.0", "released under the MIT license"]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.digest(*licenses.find(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))).collect()}
    assert got[0] == ("mit", 1.0) and got[1] == got[2] == got[4] == got[5] == got[7] == ("", 0.0)
    assert got[3] == ("bsd-3-clause", 1.0) and got[6] == ("bsd-2-clause", 1.0)
    assert got[8] == ("apache,apache-2.0-notice", licenses.NOTICE_SCORE) and got[9] == ("mit,mit-notice", licenses.NOTICE_SCORE)


@pytest.mark.parametrize("label", ["apache-2.0", "gpl-2.0", "gpl-3.0"])
def test_long_licences_need_their_last_paragraph(label):
    scanner = licenses.Scanner({}, licenses.TEMPLATES)
    body = licenses.MARK.sub(lambda m: "someone" if m[1].startswith("var") else " ", licenses.TEMPLATES[label]).lower()
    of = lambda t: {x for x, _, _ in scanner.scan(t.encode())[1]}
    assert label in of("before " + body + " after")
    words = body.split()
    assert len(words) > 1000 and label not in of(" ".join(words[:-40])) and label not in of(" ".join([*words[:-40], "changed", *words[-39:]]))


# ---- quality

def test_features_of_edge_texts():
    import pyarrow as pa
    x = quality.featurize(pa.array([None, "", "a a a b", "### ###"]))
    at = quality.FEATURES.index
    assert x.shape == (4, len(quality.FEATURES)) and np.isfinite(x).all()
    assert x[2, at("adjacent")] == 0.5 and x[2, at("repeated")] == 0.5 and x[3, at("symbol")] == pytest.approx(6 / 7)


def test_prior_and_risk_on_separable_data(spark):
    """The estimated prior is near the true one, and held-out ranks are right."""
    rng = np.random.default_rng(4)
    d = len(quality.FEATURES)
    rows = []
    for i in range(3000):
        good = rng.random() < 0.7
        x = rng.normal(size=d) * 0.5
        x[0], x[1] = 1.0, (2.0 if good else -2.0) + rng.normal() * 0.4
        rows.append(([float(v) for v in x], bool(good and i % 2), bool(good)))
    df = spark.createDataFrame(rows, "x array<double>, positive boolean, good boolean").cache()
    model = quality.fit(df)
    assert 0.6 < model.prior < 0.8
    got = df.select("good", model.column(F.col("x")).alias("p")).collect()
    assert np.mean([(r.p >= 0.5) == r.good for r in got]) > 0.98
    assert quality.fit(df.where("false")).prior == 0.5 and quality.fit(df.withColumn("positive", F.lit(False))).prior == 0.5


# ---- token counts

def test_token_counts_equal_the_library_and_reuse_the_cache(spark, docs, tmpdir_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(90, "a <|endoftext|> b")], "doc_id long, text string")
    d = docs.select("doc_id", "text").union(extra)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(lib.encode(r.text or "", add_special_tokens=False)), n > 1024) for r in d.collect())
    cache = f"{tmpdir_path}/cache"
    got = lambda x: sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count(x, cache, path).collect())
    assert got(d) == want
    stored = spark.read.parquet(cache)
    n = stored.count()
    assert n == d.select(F.coalesce("text", F.lit(""))).distinct().count() == stored.select("digest").distinct().count()
    assert got(d) == want and spark.read.parquet(cache).count() == n  # all hits now
    assert got(extra.withColumn("text", F.lit("new one"))) == [("90", 7, len(lib.encode("new one").ids), False)]
    assert spark.read.parquet(cache).count() == n + 1
    model = public_tokenizers.path("piece_bpe_32k.model")
    token_counts.count(extra, cache, model).collect()  # another tokenizer is another key
    assert spark.read.parquet(cache).count() == n + 2


def test_piecewise_counts_equal_whole_texts():
    import json

    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        rules_ = json.load(f)
    assert token_counts.separable(rules_)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"pre_tokenizer": rules_["pre_tokenizer"] | {"add_prefix_space": True}},
                   {"added_tokens": [rules_["added_tokens"][0] | {"lstrip": True}]}, {"added_tokens": [rules_["added_tokens"][0] | {"content": "a b"}]}):
        assert not token_counts.separable(rules_ | change)
    lib, rng = Tokenizer.from_file(path), np.random.default_rng(6)
    whole = lambda ts: [len(x) for x in lib.encode_batch_fast(ts, add_special_tokens=False)]
    parts = [" ", " ", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "\u180e", "a", "é", "日", "1", "'s", "'", "#", "word",
             "<|endoftext|>", "<|endo", "\u0301", "x" * 70]
    texts = ["".join(rng.choice(parts, int(k))) for k in rng.integers(0, 15, 20_000)] + ["", " ", "a" * 100_000, "ab " * 100_000, " \n" * 5000]
    count = token_counts.Pieces(whole)
    assert [n for k in range(0, len(texts), 999) for n in count(texts[k: k + 999])] == whole(texts)
    assert all(len(p) <= count.LONGEST for p in count.known)
    count.KNOWN, count.known = 50, {}  # the memo is full again and again
    assert [n for k in range(0, 2000, 20) for n in count(texts[k: k + 20])] == whole(texts[:2000])


# ---- rules

def brute_rules(t):
    t = t or ""
    w = SPACED.findall(t)
    wins = collections.defaultdict(list)
    for i in range(len(w) - 2):
        wins[tuple(w[i:i + 3])].append(i)
    rep = {j for at in wins.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep))


def test_rule_statistics_equal_brute_force(spark, docs):
    texts = ["a b c a b c a", "x\nx\n\n \nx y\nx", "a a a a", "a b", "#*|\t<é>\x0b日", "one two three four one two three", None, ""]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    d = docs.select("doc_id", "text").union(more)
    got = rules.statistics(d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert collected(got) == sorted(((r.doc_id, *brute_rules(r.text)) for r in d.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_binomial_bound_is_exact(spark):
    cases = [(k, n) for n in (1, 10, 500, 20_000) for k in (0, 1, 2, 7, 90) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", rules.log_binomial_cdf(F.col("k"), F.col("n"), 0.02).alias("l"))
    for r in df.collect():
        if r.k < r.n * 0.02:
            terms = [math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.02) + (r.n - i) * math.log(0.98) for i in range(r.k + 1)]
            top = max(terms)
            assert r.l == pytest.approx(top + math.log(sum(math.exp(t - top) for t in terms)), rel=1e-9, abs=1e-9)
        else:
            assert r.l == 0.0


def test_binomial_bound_of_a_billion(spark):
    k, p = 10**9, 0.0125
    n = int(k / p * 1.00001)
    got = spark.range(1).select(rules.log_binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    i = np.arange(k, k - 2_000_000, -1, dtype=np.float64)
    tail = np.log1p(np.exp(np.cumsum(np.log(i / (n - i + 1) * (1 - p) / p))).sum())
    top = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    assert got == pytest.approx(top + tail, abs=1e-3)  # lgamma itself is near 2e11 here


def test_cutoffs_are_certified_by_stratum(spark):
    clean = "word " * 60
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en") for i in range(2000)]
    rows += [(3000 + i, " ".join(f"v{i}#{j}###########" for j in range(60)), "de") for i in range(2000)]
    rows += [(9000, " ".join(f"q{j}#####" for j in range(60)), "en"), (9001, clean, "en"), (9002, "short", "en"), (9003, " ".join(f"q{j}#####" for j in range(60)), None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in [*range(2000), *range(3000, 5000)]], "doc_id long, quality int")
    got = {r.doc_id: r for r in rules.judge(d, labels).collect()}
    assert not got[9000].kept and got[9000].rejected_by == "symbol_ratio" and not got[9000].base_failed
    assert got[9001].base_failed and got[9002].base_failed and got[9003].kept  # no labels, no cutoff
    assert all(got[i].kept for i in [*range(2000), *range(3000, 5000)])  # symbols are usual in "de"
    assert all(not r.rejected_by for r in rules.judge(d, labels.limit(0)).collect())
    assert rules.judge(d.limit(0), labels).count() == 0


# ---- toxicity

def brute_kernel(s, t):
    def feats(x):
        sym, out = [0, *(int(toxicity.SYMBOL[b]) for b in x), 0], collections.Counter()
        for p in toxicity.PATTERNS:
            for i in range(len(sym) - p[-1]):
                out[(sym[i], *(sym[i + o] for o in p))] += toxicity.DECAY ** (p[-1] + 1)
        return out
    a, b = feats(s), feats(t)
    g = toxicity.norms(max(len(s), len(t)) + 2)
    return sum(v * b[k] for k, v in a.items()) / (g[len(s) + 2] * g[len(t) + 2])


def test_kernel_equals_brute_force():
    units = [b"idiot", b"idxiot", b"moron", b"scum", "é1été".encode(), b"abcabcab", b"ab"]
    symbol, unit, length = toxicity.marked(toxicity._Column(units))
    dense = np.zeros((len(units), 1 << toxicity.TABLE_BITS))
    for code, within, w in toxicity.occurrences(symbol, unit):
        at = np.flatnonzero(within)
        np.add.at(dense, (unit[at], code[at]), w)
    g = toxicity.norms(20)
    got = dense @ dense.T / np.outer(g[length], g[length])
    want = np.array([[brute_kernel(s, t) for t in units] for s in units])
    assert np.allclose(got, want, atol=1e-9)
    assert got[0, 1] > 0.3 > got[0, 2]


def test_machine_tolerates_gaps_and_insertions(spark):
    toxic = ["idiot", "moron", "worthless", "pathetic", "disgusting", "clown"]
    rng = np.random.default_rng(0)
    clean = ["".join(rng.choice(list("ethanorsl"), 6)) for _ in range(400)] + ["the", "of", "and", "idea", "worth", "more"]
    machine = toxicity.train(toxic, clean)
    texts = ["you idiot", "you i d i o t", "i-d-i-o-t", "an idxiot here", "worth more ideas", "a plain the of and", None, "", "!!!"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _toxic string")
    found, name = toxicity.decisions(df, machine)
    f = {r.doc_id: r[1] for r in found.select("doc_id", F.col(name)["decision"]).collect()}
    assert all(f[i] > 0 for i in (0, 1, 2, 3)) and all(f[i] < 0 for i in (4, 5, 6, 7, 8)) and f[6] == f[7] == f[8] == machine.bias


# ---- language

def brute_chain(scores, move):
    n, k = scores.shape
    post = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        w = math.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
        for i, y in enumerate(path):
            post[i, y] += w
    return post / post.sum(axis=1, keepdims=True)


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(6)
    scores, move = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 4, 5])
    got, _ = langid.forward_backward(scores, move, first)
    want = np.concatenate([brute_chain(scores[a:z], move) for a, z in ((0, 4), (4, 5), (5, 9))])
    assert np.allclose(got, want)


def test_languages_of_edge_and_mixed_texts(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    field = langid.fit(d, tx.crc_fold(F.col("doc_id"), 3) != 1, sample=20)
    by = {l: d.where(F.col("lang") == l).orderBy("doc_id").first().text for l in ("en", "de")}
    both = " ".join(by["en"].split()[:60]) + " " + " ".join(by["de"].split()[:60])
    rows = [(1, None), (2, ""), (3, "123 456 ..."), (4, both), (5, by["de"])]
    found, name = langid.label(spark.createDataFrame(rows, "doc_id long, text string"), field)
    got = {r.doc_id: r[1] for r in found.select("doc_id", name).collect()}
    assert [got[i].lang for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0 and got[5].lang == "de"
    inside = collections.Counter()
    for s in got[4].spans:
        for i in range(s.start, s.end):
            inside[("en" if i < 60 else "de") == s.lang] += 1
    assert inside[True] > 0.85 * sum(inside.values())
    none, name = langid.identify(d, F.lit(False))
    assert {r[0] for r in none.select(F.col(name)["lang"]).distinct().collect()} == {"und"}


def test_lexicon_has_long_words_and_those_of_small_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "LEXICON_WORDS", 5)
    few = {"de": ["geschwindigkeit", "zwar"], "ru": ["здравствуйте", "хорошо"]}
    rows = [("en", " ".join(f"word{i}" for i in range(30)))] * 500 + [(l, " ".join([*ws, "shared"])) for l, ws in few.items() for _ in range(3)]
    found, meaning = langid.lexicon_of(spark.createDataFrame(rows, "lang string, text string"), ["de", "en", "ru"])
    of = dict(zip(found.tolist(), meaning.tolist()))
    import pyarrow as pa
    code = lambda w: int(tx.Words(pa.array([w], pa.large_string())).hashes()[0])
    assert {w: of.get(code(w)) for ws in few.values() for w in ws} == {"geschwindigkeit": 0, "zwar": 0, "здравствуйте": 2, "хорошо": 2}
    assert sorted(meaning.tolist()) == [0, 0, 1, 1, 1, 1, 1, 2, 2] and code("shared") not in of


# ---- whole queries on the small tables

def test_classifiers_on_held_out_rows(spark):
    from salescast.llm import queries
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for query, column in ((queries.op6_quality, "quality"), (queries.op9_toxicity, "toxic")):
        got = query(spark, sf).where("held_out").join(labels, "doc_id").toPandas()
        assert (got.predicted == got[column]).mean() > 0.9 and got.score.between(0, 1).all()
    got = queries.op10_language(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97
