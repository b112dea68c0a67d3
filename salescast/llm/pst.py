"""Language-model scoring with a probabilistic suffix tree.

A text is the UTF-8 bytes of its lower-cased words, each followed by a space,
and one end symbol.  The tree's nodes are contexts of up to ``depth`` symbols.
A context is retained if it has at least ``least`` training occurrences, a
fixed number, and its next-symbol distribution diverges from that of its longest
proper suffix, by a likelihood-ratio test and by at least ``divergence`` nats;
suffixes of retained contexts are retained too.  Distributions are smoothed
towards the suffix's (Witten-Bell), and a symbol is scored in the longest
retained suffix of what precedes it.

All counts are over all training texts, and the tree grows with them: it is a
written table, never held by one process.  A table of each distinct (context,
symbol) of all texts, scored or learned from, gets its probability by one join a
context length.  Those with at least ``hot`` of all symbols (at most 1 / hot of
them), like words with at least ``frequent`` of all tokens, are looked up in a
broadcast, which takes the hottest keys out of the join; the rest go through
a shuffle by word or (context, symbol).  The two shares choose the path only:
results don't depend on them.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.session import materialize

DEPTH = 5
LEAST, DIVERGENCE = 2, 0.002
FREQUENT, HOT = 1e-6, 2e-7
END, GAP = b"\n", b" "
#: Words and n-grams that a task gathers before it emits them.
TASK_WORDS, TASK_GRAMS = 400_000, 3_000_000
NO_KEYS, NO_SUMS = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)


def symbols(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Per symbol of all texts its context and itself in one integer, the
    number of symbols of each text, and the words."""
    split = [t.lower().split() for t in texts]
    pad = END * (depth - 1)
    blocks = [GAP.join(ws) + GAP + END if ws else END for ws in split]
    raw = np.frombuffer(END * depth + b"".join([b + pad for b in blocks]), np.uint8)
    grams = np.zeros(len(raw) - depth, np.uint64)
    for k in range(depth + 1):
        grams <<= np.uint64(8)
        grams |= raw[k: len(grams) + k]
    lengths = np.array([len(b) for b in blocks], np.int64)
    own = np.ones(len(grams), bool)
    ends = np.cumsum(lengths + depth - 1)
    for k in range(1, depth):
        own[ends - k] = False
    return grams[own], lengths, split


def coded(split: list[list[bytes]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of all lists, and for each word of each list its place
    among them and the number of its list."""
    words = pa.array([w for ws in split for w in ws], pa.large_binary()).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), np.repeat(np.arange(len(split)), [len(ws) for ws in split])


def _gather(batches, depth):
    """Training counts of words, and of each (context, symbol) its training
    count and its count in all texts, gathered within the task."""
    counts, keys, sums = Counter(), [], []

    def rows(words, grams, n):
        k = len(words)
        return pa.RecordBatch.from_arrays([
            pa.array([w.decode("utf-8", "replace") for w in words] + [None] * len(grams), pa.string()),
            pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(grams.astype(np.int64))]),
            pa.concat_arrays([pa.array(list(words.values()), pa.int64()), pa.array(n[:, 0])]),
            pa.concat_arrays([pa.array([0] * k, pa.int64()), pa.array(n[:, 1])])], names=["word", "gram", "n", "m"])

    def folded():
        key, n = np.concatenate([NO_KEYS, *keys]), np.concatenate([NO_SUMS, *sums])
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[first], np.add.reduceat(n, first, axis=0) if len(key) else n

    for batch in batches:
        for piece in tx.pieces(batch, "text"):
            texts = [(t or "").encode() for t in piece.column(0).to_pylist()]
            held = np.array(piece.column(1).to_pylist(), bool)
            grams, lengths, split = symbols(texts, depth)
            for ws, skip in zip(split, held):
                if not skip:
                    counts.update(ws)
                    counts[END] += 1
            key, m = np.unique(grams, return_counts=True)
            n = m.copy()
            key_held, n_held = np.unique(grams[np.repeat(held, lengths)], return_counts=True)
            n[np.searchsorted(key, key_held)] -= n_held
            keys.append(key)
            sums.append(np.stack([n, m], axis=1))
            if sum(map(len, keys)) > TASK_GRAMS:
                key, n = folded()
                keys, sums = [key], [n]
                if len(key) > TASK_GRAMS // 2:
                    yield rows({}, key, n)
                    keys, sums = [], []
            if len(counts) > TASK_WORDS:
                yield rows(counts, NO_KEYS, NO_SUMS)
                counts = Counter()
    yield rows(counts, *folded())


@dataclass
class Tree:
    """The tree in memory, for small inputs and as the reference of
    ``probabilities``.  Per context length: sorted (context, symbol) keys with
    log10 probabilities, and sorted contexts with the log10 weight of the suffix."""
    depth: int
    keys: list
    logp: list
    states: list
    back: list

    def score(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol in its longest retained suffix."""
        out, todo = np.zeros(len(grams)), np.arange(len(grams))
        context = grams >> np.uint64(8)
        for k in range(self.depth, -1, -1):
            if not len(todo):
                break
            held = context[todo] & np.uint64(256**k - 1)
            at, known = _find(self.states[k], held)
            at2, seen = _find(self.keys[k], (held << np.uint64(8)) | (grams[todo] & np.uint64(255)))
            done = known & seen
            out[todo[done]] += self.logp[k][at2[done]]
            lower = known & ~seen
            out[todo[lower]] += self.back[k][at[lower]]
            todo = todo[~done]
        return out


def _find(keys, wanted):
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Table:
    """Look-up of the values of distinct keys, all at once: keys in the order of
    a hash, whose leading bits name a short run of them."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(10, int(4 * len(keys)).bit_length()))
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        # one more row ends the last run
        self.keys, self.values = np.append(keys[order], keys[:1]), np.append(values[order], np.nan)
        self.first = np.searchsorted(slot[order], np.arange((1 << 64 - int(self.shift)) + 1)).astype(np.int32)

    def _slot(self, keys):
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, wanted: np.ndarray) -> np.ndarray:
        """The value of each wanted key; nan for one that is not held."""
        out = np.full(len(wanted), np.nan)
        slot = self._slot(wanted)
        at, stop = self.first[slot], self.first[slot + 1]
        todo = np.flatnonzero(at < stop)
        at, stop, wanted = at[todo], stop[todo], wanted[todo]
        while len(todo):
            same = self.keys[at] == wanted
            out[todo[same]] = self.values[at[same]]
            at = at + 1
            more = np.flatnonzero(~same & (at < stop))
            todo, at, stop, wanted = todo[more], at[more], stop[more], wanted[more]
        return out


def pair_counts(of: np.ndarray, grams: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of a row number and a (context, symbol), and how often each is there."""
    bits = 8 * (depth + 1)
    if int(of.max()) >> (64 - bits) == 0:  # both fit one integer
        pair, n = np.unique((of.astype(np.uint64) << np.uint64(bits)) | grams, return_counts=True)
        return (pair >> np.uint64(bits)).astype(np.int64), pair & np.uint64(2**bits - 1), n
    order = np.lexsort((grams, of))
    of, grams = of[order], grams[order]
    first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (grams[1:] != grams[:-1])]))
    return of[first], grams[first], np.diff(np.append(first, len(of)))


def counted(grams: DataFrame, depth: int) -> DataFrame:
    """(k, ctx, sym, n, tot, kinds, up, un, utot, ukinds) of each (context,
    symbol) of length k, ``grams`` holding each of full length once, and of its
    suffix.  Symbols with n = 0 are of texts that are not learned from."""
    levels = []
    for k in range(depth, -1, -1):
        grams = grams.groupBy(F.col("gram").bitwiseAND(F.lit(256**(k + 1) - 1)).alias("gram")).agg(F.sum("n").alias("n"))
        grams = materialize(grams, name=f"pst-grams-{k}")
        one = grams.select(F.shiftright("gram", 8).alias("ctx"), F.col("gram").bitwiseAND(F.lit(255)).alias("sym"), "n")
        sums = one.groupBy("ctx").agg(F.sum("n").alias("tot"), F.count_if(F.col("n") > 0).alias("kinds"))
        levels.insert(0, one.join(sums, "ctx").select(F.lit(k).alias("k"), "ctx", "sym", "n", "tot", "kinds"))
    out = levels[0].select("*", F.lit(None).cast("long").alias("up"), *[F.lit(None).cast("long").alias(c) for c in ("un", "utot", "ukinds")])
    for k in range(1, depth + 1):
        suffix = levels[k - 1].select(F.col("ctx").alias("up"), "sym", F.col("n").alias("un"), F.col("tot").alias("utot"), F.col("kinds").alias("ukinds"))
        up = F.col("ctx").bitwiseAND(F.lit(256**(k - 1) - 1))
        out = out.unionByName(levels[k].withColumn("up", up).join(suffix, ["up", "sym"]))
    return out


def kept_contexts(levels: DataFrame, depth: int, least: float, divergence: float) -> DataFrame:
    """(k, ctx) of the retained contexts, each suffix of one included."""
    gain = F.sum(F.col("n") * F.log((F.col("n") / F.col("tot")) / (F.col("un") / F.col("utot"))))
    tested = (levels.where((F.col("k") > 0) & (F.col("n") > 0) & (F.col("tot") >= least)).groupBy("k", "ctx")
              .agg(gain.alias("gain"), F.max("tot").alias("tot"), F.greatest(F.max("ukinds") - 1, F.lit(1)).alias("df")))
    own = tested.where((2 * F.col("gain") > F.col("df") + 3 * F.sqrt(2 * F.col("df"))) & (F.col("gain") >= divergence * F.col("tot")))
    suffixes = F.array(*[F.struct(F.lit(j).alias("k"), F.col("ctx").bitwiseAND(F.lit(256**j - 1)).alias("ctx")) for j in range(depth + 1)])
    return own.select(F.explode(F.slice(suffixes, F.lit(1), F.col("k") + 1)).alias("s")).select("s.*").distinct()


def retained(grams: DataFrame, depth: int, least: float = LEAST, divergence: float = DIVERGENCE) -> DataFrame:
    """(k, ctx, sym, n, tot, kinds) of the retained contexts of each length k."""
    levels = materialize(counted(grams, depth), name="pst-levels")
    kept = kept_contexts(levels, depth, least, divergence)
    learned = levels.where("n > 0").select("k", "ctx", "sym", "n", "tot", "kinds")
    return learned.where("k > 0").join(kept, ["k", "ctx"], "left_semi").unionByName(learned.where("k = 0"))


def probabilities(grams: DataFrame, depth: int, least: float = LEAST, divergence: float = DIVERGENCE) -> DataFrame:
    """(gram, logp): log10 probability of the symbol of each row of ``grams``
    (gram, n) in the longest retained suffix of its context."""
    levels = materialize(counted(grams, depth), name="pst-levels")
    kept = materialize(kept_contexts(levels, depth, least, divergence).withColumn("known", F.lit(True)), name="pst-kept")
    p = levels.where("k = 0").select(F.col("ctx").alias("up"), "sym", ((F.col("n") + 1) / (F.col("tot") + 256)).alias("p"))
    for k in range(1, depth + 1):
        known = kept.where(F.col("k") == k).select("ctx", "known")
        smoothed = F.when(F.col("known"), (F.col("n") + F.col("kinds") * F.col("p")) / (F.col("tot") + F.col("kinds"))).otherwise(F.col("p"))
        p = (levels.where(F.col("k") == k).select("ctx", "sym", "n", "tot", "kinds", "up").join(known, "ctx", "left").join(p, ["up", "sym"])
             .select(F.col("ctx").alias("up"), "sym", smoothed.alias("p")))
    return p.select(F.shiftleft("up", 8).bitwiseOR(F.col("sym")).alias("gram"), F.log10("p").alias("logp"))


def grow(rows: pa.Table, depth: int) -> Tree:
    """The smoothed tree of retained contexts, in memory."""
    col = {c: rows.column(c).to_numpy() for c in ("k", "ctx", "sym", "n", "tot", "kinds")}
    tree = Tree(depth, [], [], [], [])
    probs = []
    for k in range(depth + 1):
        pick = np.flatnonzero(col["k"] == k)
        key = (col["ctx"][pick].astype(np.uint64) << np.uint64(8)) | col["sym"][pick].astype(np.uint64)
        order = np.argsort(key)
        pick, key = pick[order], key[order]
        n, tot, kinds = (col[c][pick].astype(float) for c in ("n", "tot", "kinds"))
        states, first = np.unique(key >> np.uint64(8), return_index=True)
        if k == 0:  # all 256 symbols, with one added to each count
            p = np.ones(256)
            p[key.astype(np.int64)] += n
            p /= p.sum()
            key, states, back = np.arange(256, dtype=np.uint64), np.zeros(1, np.uint64), np.zeros(1)
        else:
            kept = np.add.reduceat(n, first) if len(n) else n
            weight = (kinds[first] + tot[first] - kept) / (tot[first] + kinds[first])
            at, found = _find(tree.keys[k - 1], key & np.uint64(256**k - 1))
            assert found.all(), "a stored symbol of a context is stored for its suffix"
            p = n / (tot + kinds) + weight[np.searchsorted(states, key >> np.uint64(8))] * probs[k - 1][at]
            with np.errstate(divide="ignore"):
                back = np.log10(weight)
        probs.append(p)
        tree.keys.append(key)
        tree.logp.append(np.log10(p).astype(np.float32))
        tree.states.append(states)
        tree.back.append(back)
    return tree


def score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH,
          least: float = LEAST, divergence: float = DIVERGENCE, frequent: float = FREQUENT, hot: float = HOT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for each row; rows where ``train`` is true are learned from.

    A null text is empty and has one token, its end; so has a blank one.  Rows
    with a null id (never held out unless ``train`` says so) and repeated rows
    are scored one by one.  With no training row, all counts are zero and all
    symbols are equally likely.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(text).alias("text"), (~F.coalesce(train, F.lit(True))).alias("held_out"), F.col(doc_id).alias("doc_id"))
    schema = tx.struct_type(word=T.StringType(), gram=T.LongType(), n=T.LongType(), m=T.LongType())
    gathered = (base.select("text", "held_out").mapInArrow(lambda b: _gather(b, depth), schema)
                .groupBy("word", "gram").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))
    gathered = materialize(gathered, name="pst-counts")
    counts = gathered.where("word is not null").select("word", F.col("n").alias("c"))
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_all, n_kinds = sums["n"] or 0, sums["v"]
    grams = gathered.where("word is null").select("gram", "n", "m")
    n_symbols = grams.agg(F.sum("m")).first()[0] or 0
    scored = materialize(probabilities(grams.select("gram", "n"), depth, least, divergence)
                         .join(grams.select("gram", (F.col("m") >= hot * n_symbols).alias("hot")), "gram"), name="pst-scored")
    known = scored.where("hot").select("gram", "logp").toArrow()
    keys, logp = known.column("gram").to_numpy().astype(np.uint64), known.column("logp").to_numpy()
    order = np.argsort(keys)
    words = counts.where(F.col("c") >= frequent * n_all).toArrow()
    words = dict(zip((w.encode() for w in words.column("word").to_pylist()), words.column("c").to_pylist()))
    model = spark.sparkContext.broadcast((depth, keys[order], logp[order], words))
    emitted = (base.withColumn("row", F.monotonically_increasing_id())
               .mapInArrow(lambda b: _emit(b, model.value), tx.struct_type(
                   row=T.LongType(), word=T.StringType(), gram=T.LongType(), tf=T.LongType(), doc_id=docs.schema[doc_id].dataType,
                   held_out=T.BooleanType(), n_tokens=T.LongType(), n_known=T.LongType(), base=T.DoubleType(), score=T.DoubleType())))
    rare = (counts.where(F.col("c") < frequent * n_all).select(_key(F.col("word"), F.lit(None)).alias("key"), F.col("word").alias("known_word"), "c", F.lit(None).cast("double").alias("logp"))
            .unionByName(scored.where("not hot").select(F.col("gram").alias("key"), F.lit(None).cast("string").alias("known_word"), F.lit(None).cast("long").alias("c"), "logp")))
    c = F.coalesce("c", F.lit(0))
    emitted = emitted.withColumn("key", _key(F.col("word"), F.col("gram"))).drop("gram")
    same = (emitted["key"] == rare["key"]) & F.coalesce(emitted["word"] == rare["known_word"], F.lit(True))
    parts = emitted.join(rare, same, "left").select(
        "row", "doc_id", "held_out", "n_tokens", F.coalesce("n_known", F.when(c > 0, F.col("tf")).otherwise(0)).alias("known"),
        F.coalesce("base", F.col("tf") * F.log10(c + 1.0)).alias("base"), F.coalesce("score", F.col("tf") * F.col("logp"), F.lit(0.0)).alias("score"))
    done = parts.groupBy("row").agg(*[F.max(x).alias(x) for x in ("doc_id", "held_out", "n_tokens")],
                                    F.sum("known").alias("n_known"), F.sum("base").alias("base"), F.sum("score").alias("score"))
    scale = float(np.log10(n_all + n_kinds + 1)) if n_all else 0.0
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("bigint").alias("train_tokens"),
                       (F.col("base") - F.col("n_tokens") * scale).alias("base_score"), "score")


def _key(word: Column, gram: Column) -> Column:
    """One integer to join on: the (context, symbol), which is not negative, or
    a negative hash of the word; equal words are checked beside it."""
    return F.coalesce(gram, F.xxhash64(word).bitwiseOR(F.lit(-2**63)))


def _emit(batches, model):
    """A row for each document, with what its frequent words and symbols sum to,
    and one for each of its other words and (context, symbol) pairs.  A
    document's row has a word of its own, with a space in it, so that no join
    key is shared by the documents."""
    depth, keys, known_logp, words = model
    frequent_words = pa.array(words.keys(), pa.large_binary())
    logs = np.append(np.log10(np.array([*words.values()], float) + 1), np.nan)
    table = Table(keys, known_logp)
    names = ["row", "word", "gram", "tf", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"]
    for batch in batches:
        for piece in tx.pieces(batch, "text"):
            texts = [(t or "").encode() for t in piece.column(0).to_pylist()]
            grams, lengths, split = symbols(texts, depth)
            logp = table.look_up(grams)
            tail = np.isnan(logp)
            scores = np.add.reduceat(np.where(tail, 0.0, logp), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
            ids = piece.column(3).to_numpy()
            distinct, word, of = coded([[*ws, END] for ws in split])
            value = logs[pc.fill_null(pc.index_in(distinct, value_set=frequent_words), len(logs) - 1).to_numpy()][word]
            frequent = ~np.isnan(value)
            known = np.bincount(of[frequent], minlength=len(ids))
            based = np.bincount(of[frequent], value[frequent], minlength=len(ids))
            pair, tail_n = np.unique(of[~frequent] * np.int64(len(distinct)) + word[~frequent], return_counts=True)
            tail_row, tail_word = ids[pair // max(1, len(distinct))], distinct.take(pa.array(pair % max(1, len(distinct))))

            def rows(row, word, gram, n, doc=None):
                doc = doc or [pa.nulls(len(row), k) for k in (piece.column(2).type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), word, gram, pa.array(n, pa.int64()), *doc], names=names)

            none = lambda n: pa.nulls(n, pa.int64())
            yield rows(ids, pa.array([f" {r}" for r in ids.tolist()], pa.string()), none(len(ids)), np.zeros(len(ids), np.int64), [
                piece.column(2), piece.column(1), pa.array([len(ws) + 1 for ws in split], pa.int64()), pa.array(known, pa.int64()),
                pa.array(based, pa.float64()), pa.array(scores, pa.float64())])
            if len(pair):
                yield rows(tail_row, tail_word.cast(pa.large_string()).cast(pa.string()), none(len(pair)), tail_n)
            if tail.any():
                at, gram, n = pair_counts(np.repeat(np.arange(len(ids)), lengths)[tail], grams[tail], depth)
                yield rows(ids[at], pa.nulls(len(at), pa.string()), pa.array(gram.astype(np.int64)), n)
