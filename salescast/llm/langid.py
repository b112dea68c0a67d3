"""Language identification by a linear-chain conditional random field.

Each line of a text is a chain of words.  A word's features are its affixes (of
one to three bytes), its byte n-grams (two and three), the language that the
lexicon has it under, and a bias; transitions between the
languages of neighbouring words are learned.  Forward-backward gives each word's
posterior over the languages, so the words of code-switched text are labelled
one by one; a document's language has the largest sum of posteriors.

The lexicon's counts are over all words of all learnable documents; it holds
up to ``LEXICON_WORDS`` of each language, those with the largest share of the
language's own words, so no language takes the place of another.  The field's weights are
fitted on a bounded sample of them, ``SAMPLE`` documents a language (the first
by a hash of the id); half of the sample's lines are joined in pairs, so that
switches between languages are seen.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.session import materialize

UNKNOWN = "und"
TABLE_BITS = 18
SAMPLE, ROUNDS, RATE, DECAY = 60, 24, 0.2, 1e-4
#: Characters of a text that is sampled only where its language has too few shorter ones.
LONG_TEXT = 200_000
#: Most words of each language in the lexicon, and least share of a word's uses that are its language's.
LEXICON_WORDS, LEXICON_SHARE = 20_000, 0.6
TASK_WORDS = 400_000


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray      # (2^TABLE_BITS, languages)
    transitions: np.ndarray  # (languages, languages), log weights
    lexicon: np.ndarray      # sorted hashes of words
    meaning: np.ndarray      # their languages


def slot(code: np.ndarray, kind: int) -> np.ndarray:
    return (((code * 64 + kind) * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - TABLE_BITS)


def word_features(seen: tx.Words, lexicon: np.ndarray, meaning: np.ndarray):
    """(word, feature) arrays, one pair of them for each kind of feature."""
    n = len(seen.start)
    every = np.arange(n)
    yield every, slot(np.zeros(n, np.int64), 0)
    if not n:
        return
    b, length = seen.bytes.astype(np.int64), seen.end - seen.start
    inside = np.flatnonzero(seen.inside)
    word = np.repeat(every, length)
    left = np.repeat(seen.end, length) - inside
    for size in (2, 3):
        ok = left >= size
        at = inside[ok]
        yield word[ok], slot(_packed(b, at, size), size)
    for size in (1, 2, 3):
        ok = length >= size
        yield every[ok], slot(_packed(b, seen.start[ok], size), 3 + size)
        yield every[ok], slot(_packed(b, seen.end[ok] - size, size), 6 + size)
    if len(lexicon):
        h = seen.hashes()
        at = np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)
        ok = lexicon[at] == h
        yield every[ok], slot(meaning[at[ok]].astype(np.int64), 10)


def _packed(b, at, size):
    code = b[at]
    for k in range(1, size):
        code = (code << 8) | b[at + k]
    return code


def emissions(field: Field, seen: tx.Words) -> np.ndarray:
    out = np.zeros((len(seen.start), len(field.languages)))
    for word, feature in word_features(seen, field.lexicon, field.meaning):
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(word, field.weights[feature, k], minlength=len(out))
    return out


def lines(seen: tx.Words) -> np.ndarray:
    """First word of each chain: words of one text and one line."""
    if not len(seen.start):
        return np.zeros(0, np.int64)
    line = np.cumsum(seen.bytes == 10)[seen.start]
    doc = seen.doc()
    return np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])]))


def forward_backward(scores: np.ndarray, transitions: np.ndarray, first: np.ndarray, pairs: bool = False):
    """Posteriors of all words (and expected transitions) of chains that start
    at ``first``; all chains advance together, word by word."""
    n, k = scores.shape
    if not n:
        return scores, np.zeros((k, k))
    length = np.diff(np.concatenate([first, [n]]))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    active = np.searchsorted(-length, -np.arange(length[0]), "left")  # chains with more than t words
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    alpha, expected = np.empty_like(e), np.zeros((k, k))
    a = e[first]
    for t in range(length[0]):
        at = first[:active[t]] + t
        a = a if t == 0 else (a[:active[t]] @ move) * e[at]
        a /= a.sum(axis=1, keepdims=True)
        alpha[at] = a
    b = np.ones((len(first), k))
    out = np.empty_like(e)
    for t in range(length[0] - 1, -1, -1):
        m = active[t]
        at = first[:m] + t
        post = alpha[at] * b[:m]
        out[at] = post / post.sum(axis=1, keepdims=True)
        later = e[at] * b[:m]
        if pairs and t:
            both = alpha[at - 1][:, :, None] * move * later[:, None, :]
            expected += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        later = later @ move.T
        b[:m] = later / later.sum(axis=1, keepdims=True)
    return out, expected


def train(texts: list[str], labels: list[int], languages: list[str], lexicon=None, meaning=None, rounds: int = ROUNDS) -> Field:
    """Maximum-likelihood weights by gradient steps over the whole sample."""
    k = len(languages)
    lexicon = np.zeros(0, np.uint64) if lexicon is None else lexicon
    meaning = np.zeros(0, np.int64) if meaning is None else meaning
    field = Field(languages, np.zeros((1 << TABLE_BITS, k)), np.zeros((k, k)), lexicon, meaning)
    rng = np.random.default_rng(5)
    rows = [(line, y) for t, y in zip(texts, labels) for line in t.split("\n") if line.strip()]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    seen = tx.Words(pa.array([r[0] for r in rows], pa.large_string()))
    truth = np.array([r[1] for r in rows], np.int64)[seen.doc()] if rows else np.zeros(0, np.int64)
    starts = seen.first[:-1]
    # every second line of the first half goes on with the line before it
    alone = np.ones(len(starts), bool)
    alone[1: len(starts) // 2: 2] = False
    first = np.unique(starts[alone & (seen.counts() > 0)])
    if not len(truth) or first[0] != 0:
        first = np.unique(np.concatenate([[0], first])) if len(truth) else first
    if not len(truth):
        return field
    found = list(word_features(seen, lexicon, meaning))
    word, feature = (np.concatenate(x) for x in zip(*found))
    used, feature = np.unique(feature, return_inverse=True)
    w = np.zeros((len(used), k))
    target = np.eye(k)[truth]
    inner = np.ones(len(truth), bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    told = np.zeros((k, k))
    np.add.at(told, (truth[at - 1], truth[at]), 1)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros((k, k)), np.zeros((k, k))]
    n = len(truth)
    for r in range(1, rounds + 1):
        scores = np.stack([np.bincount(word, w[feature, j], minlength=n) for j in range(k)], axis=1)
        post, expected = forward_backward(scores, field.transitions, first, pairs=True)
        miss = target - post
        grads = (np.stack([np.bincount(feature, miss[word, j], minlength=len(used)) for j in range(k)], axis=1) / n - DECAY * w,
                 (told - expected) / n - DECAY * field.transitions)
        for i, (g, x) in enumerate(zip(grads, (w, field.transitions))):
            m, v = state[2 * i], state[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += RATE * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    field.weights[used] = w
    return field


def _counted(batches):
    """Counts of the words' hashes by language, gathered within a task."""
    seen: dict[str, list] = {}

    def folded(parts):
        word, at = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
        return word, np.bincount(at, np.concatenate([n for _, n in parts]), len(word)).astype(np.int64)

    def rows():
        for lang, parts in seen.items():
            word, n = folded(parts)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array([lang] * len(word), pa.string()), pa.array(n)], names=["word", "lang", "n"])

    def held():
        return sum(len(h) for parts in seen.values() for h, _ in parts)

    for batch in batches:
        for piece in tx.pieces(batch, "text"):
            w = tx.Words(piece.column(0))
            h, langs = w.hashes(), np.array(piece.column(1).to_pylist(), dtype=object)
            for lang in set(langs):
                seen.setdefault(lang, []).append(np.unique(h[(langs == lang)[w.doc()]], return_counts=True))
            if held() > 2 * TASK_WORDS:
                seen = {lang: [folded(parts)] for lang, parts in seen.items()}
                if held() > TASK_WORDS:
                    yield from rows()
                    seen = {}
    yield from rows()


def lexicon_of(learn: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and languages of each language's most frequent words among those
    that one language holds most uses of (each language's counts taken as
    shares of its words)."""
    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("n", T.LongType())])
    counts = materialize(learn.select("text", "lang").mapInArrow(_counted, schema).groupBy("word", "lang").agg(F.sum("n").alias("n")), name="lang-words")
    total = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    share = F.element_at(F.create_map(*[F.lit(x) for l in languages for x in (l, 1.0 / max(1, total.get(l, 0)))]), F.col("lang")) * F.col("n")
    best = (counts.withColumn("share", share).groupBy("word")
            .agg(F.max(F.struct("share", "lang")).alias("top"), F.sum("share").alias("all"), F.sum("n").alias("n"))
            .where((F.col("top.share") >= LEXICON_SHARE * F.col("all")) & (F.col("n") > 2)).select("word", "top.share", "top.lang"))
    best = materialize(best, name="lang-lexicon")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("share"), "word"))
    top = best.withColumn("place", place).where(F.col("place") <= LEXICON_WORDS).select("word", "lang").toArrow().to_pydict()
    number = {l: i for i, l in enumerate(languages)}
    h, mean = np.array(top["word"], np.int64).view(np.uint64), np.array([number[l] for l in top["lang"]], np.int64)
    order = np.argsort(h)
    return h[order], mean[order]


def fit(docs: DataFrame, train_on: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Field:
    learn = (docs.where(F.coalesce(train_on, F.lit(False)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
             .select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")))
    languages = sorted(r.lang for r in learn.select("lang").distinct().collect())
    if not languages:
        return Field([], np.zeros((1 << TABLE_BITS, 0)), np.zeros((0, 0)), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    # a text of an id is sampled once, and a long one only where a language has too few others
    keys = ["doc_id", "lang", "digest"]
    learn = learn.withColumn("digest", F.md5(F.col("text").cast("binary")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("long", F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id", "digest"))
    ids = (learn.where("doc_id is not null").select(*keys, (F.length("text") > LONG_TEXT).alias("long")).distinct()
           .withColumn("place", place).where(F.col("place") <= sample).select(*keys))
    rows = learn.join(ids, keys, "left_semi").dropDuplicates(keys).select("text", "lang").toArrow().to_pydict()
    order = sorted(range(len(rows["text"])), key=lambda i: (rows["text"][i], rows["lang"][i]))
    lexicon, meaning = lexicon_of(learn, languages)
    return train([rows["text"][i] for i in order], [languages.index(rows["lang"][i]) for i in order], languages, lexicon, meaning)


SPAN = ("lang", "start", "end")
KIND = tx.struct_type(lang=T.StringType(), score=T.DoubleType(),
                      spans=T.ArrayType(tx.struct_type(lang=T.StringType(), start=T.LongType(), end=T.LongType())))


def label(docs: DataFrame, field: Field, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column: the document's language, its mean
    posterior, and the runs of words of one language.

    A null text and a text without a letter are ``und`` with score 0 and no
    runs, and so is every text if no language was learned.
    """
    held = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        field = held.value
        names = np.array([*field.languages, UNKNOWN], dtype=object)
        k = len(field.languages)

        def work(piece, at):
            seen = tx.Words(piece.column(at))
            n, doc = piece.num_rows, seen.doc()
            ascii_letters = np.concatenate([[0], np.cumsum((seen.bytes >= 97) & (seen.bytes <= 122))])
            lettered = np.diff(ascii_letters[seen.offsets]) > 0
            for d in np.flatnonzero(~lettered & (seen.counts() > 0)):
                lettered[d] = any(c.isalpha() for c in piece.column(at)[int(d)].as_py())
            if k == 0:
                lettered[:] = False
                post = np.zeros((len(doc), 1))
            else:
                post, _ = forward_backward(emissions(field, seen), field.transitions, lines(seen))
            total = np.stack([np.bincount(doc, post[:, j], minlength=n) for j in range(post.shape[1])], axis=1)
            best = np.where(lettered, total.argmax(axis=1), k)
            score = np.where(lettered, total.max(axis=1) / np.maximum(seen.counts(), 1), 0.0)
            own = post.argmax(axis=1) if len(doc) else np.zeros(0, np.int64)
            cut = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])])) if len(doc) else np.zeros(0, np.int64)
            cut = cut[lettered[doc[cut]]] if len(cut) else cut
            stop = np.minimum(np.append(cut[1:], len(doc)), seen.first[doc[cut] + 1]) if len(cut) else cut
            runs = pa.StructArray.from_arrays(
                [pa.array(names[own[cut]], pa.string()), pa.array(cut - seen.first[doc[cut]], pa.int64()), pa.array(stop - seen.first[doc[cut]], pa.int64())], names=list(SPAN))
            offsets = np.searchsorted(doc[cut] if len(cut) else np.zeros(0, np.int64), np.arange(n + 1)).astype(np.int32)
            return [pa.array(names[best], pa.string()), pa.array(np.clip(score, 0, 1)), pa.ListArray.from_arrays(pa.array(offsets), runs)]
        return work

    return tx.annotate(docs, text, KIND, make, "_language")


def identify(docs: DataFrame, train_on: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[DataFrame, str]:
    """Learns from the rows where ``train_on`` holds (a null text, language or
    condition is not learned from; repeated rows count as often as they come in
    the lexicon, and once in the sample that weights are fitted on)
    and labels all rows."""
    return label(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), fit(docs, train_on, doc_id, text, lang))
