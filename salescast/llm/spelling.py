"""Spelling variants by k-d trees over letter-count vectors.

One edit changes the letter counts of a word little: a replaced letter takes one
from a count and adds one to another (L1 distance two, lengths equal), an
inserted letter adds one (L1 distance one, lengths L and L + 1).  For each length
pair, a k-d tree over the letter counts of the words of the longer length is
searched for all words of the other: a box is pruned if reaching it takes more
than one letter added, or more than one (none, for an insertion) taken away.
What is left within the distance is verified on the order of the letters.

The tree has an upper part, split on a bounded sample of the words so that its
leaves hold about ``PART`` words, and lower parts, built inside tasks over all
words of a leaf.  A word is stored in one leaf and asks all leaves that the upper
part cannot prune; a leaf that turned out larger than planned is dealt by hash
into several, each of which gets all the leaf's questions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx
from salescast.session import materialize

RUN = r"[a-zÀ-ÿ]+"
SHORTEST, LEAST = 5, 3
#: One (document, word) in so many loses a letter: spelling errors to be found.
DAMAGED = 97
#: Words of a leaf of the upper tree, words that it is split on, points of a lower leaf.
PART, SAMPLE, LEAF = 50_000, 200_000, 32
#: Bytes of letters compared at once.
BLOCK = 1 << 22

#: Numbers of the letters: a-z, then U+00C0 to U+00FF.
SYMBOL = np.full(256, 255, np.uint8)
SYMBOL[97:123] = np.arange(26)
SYMBOL[192:256] = np.arange(26, 90)
SYMBOLS = 90

ASKED = tx.struct_type(size=T.IntegerType(), part=T.IntegerType(), stored=T.BooleanType(), word=T.StringType(), n=T.LongType())
PAIRS = tx.struct_type(word=T.StringType(), near=T.StringType(), near_n=T.LongType())


# ---- words

def damaged(doc_id: Column, word: Column) -> Column:
    """The word, less one letter where 97 divides the hash of the id and it."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(h % DAMAGED == 0, cut).otherwise(word)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    runs = F.regexp_extract_all(tx.lower_ascii(F.col(text)), F.lit(RUN), F.lit(0))
    each = docs.select(F.col(doc_id).alias("doc_id"), F.explode(runs).alias("run")).where(F.char_length("run") >= SHORTEST)
    words = each.select(damaged(F.col("doc_id"), F.col("run")).alias("word")).where(F.char_length("word") >= SHORTEST)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)


def letters(words: list[str], size: int) -> np.ndarray:
    """Symbol numbers, a row for each of the words of one size."""
    return SYMBOL[np.frombuffer("".join(words).encode("latin-1"), np.uint8)].reshape(len(words), size)


def counts(symbols: np.ndarray) -> np.ndarray:
    """Letter-count vectors of rows of symbols."""
    n, size = symbols.shape
    at = symbols + np.arange(n, dtype=np.int64)[:, None] * SYMBOLS
    return np.bincount(at.ravel(), minlength=n * SYMBOLS).reshape(n, SYMBOLS).astype(np.int32)


# ---- trees

class Node:
    """A box of a k-d tree: bounds, and either two halves or a leaf's points."""

    __slots__ = ("dim", "cut", "low", "high", "points", "lo", "hi", "number")

    def __init__(self):
        self.points = self.low = self.high = None


def build(points: np.ndarray, at: np.ndarray, most: int) -> Node:
    """Tree over ``points[at]``: each box is cut at the middle of the letter
    that divides it most evenly, until it has ``most`` points or all are equal."""
    node = Node()
    mine = points[at]
    node.lo, node.hi = mine.min(axis=0), mine.max(axis=0)
    spread = np.flatnonzero(node.hi > node.lo)
    if len(at) <= most or not len(spread):
        node.points = at
        return node
    middle = np.minimum(np.sort(mine[:, spread], axis=0)[(len(at) - 1) // 2], node.hi[spread] - 1)
    above = (mine[:, spread] > middle).sum(axis=0)
    best = int(np.abs(2 * above - len(at)).argmin())
    node.dim, node.cut = int(spread[best]), int(middle[best])
    right = mine[:, node.dim] > node.cut
    node.low, node.high = build(points, at[~right], most), build(points, at[right], most)
    return node


def search(node: Node, asked: np.ndarray, who: np.ndarray, down: int):
    """Leaves with the questions that their boxes cannot be pruned for: at most
    one letter more, and at most ``down`` fewer, leads from the word to the box."""
    more = np.maximum(node.lo - asked[who], 0).sum(axis=1)
    fewer = np.maximum(asked[who] - node.hi, 0).sum(axis=1)
    who = who[(more <= 1) & (fewer <= down)]
    if not len(who):
        return
    if node.points is not None:
        yield node, who
        return
    yield from search(node.low, asked, who, down)
    yield from search(node.high, asked, who, down)


class Upper:
    """The upper tree of one size: cells that cover all vectors, so that words
    outside the sample have a place; bounds are those of the cuts alone."""

    def __init__(self, sample: np.ndarray, most: int):
        self.leaves = 0
        self.root = self._open(build(sample, np.arange(len(sample)), most), np.zeros(SYMBOLS, np.int32), np.full(SYMBOLS, 2**30, np.int32))

    def _open(self, node: Node, lo: np.ndarray, hi: np.ndarray) -> Node:
        node.lo, node.hi = lo, hi
        if node.points is not None:
            node.number, node.points = self.leaves, ()
            self.leaves += 1
            return node
        below, above = hi.copy(), lo.copy()
        below[node.dim], above[node.dim] = node.cut, node.cut + 1
        self._open(node.low, lo, below)
        self._open(node.high, above, hi)
        return node

    def place(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        work = [(self.root, np.arange(len(points)))]
        while work:
            node, at = work.pop()
            if node.points is not None:
                out[at] = node.number
                continue
            right = points[at, node.dim] > node.cut
            work += [(node.low, at[~right]), (node.high, at[right])]
        return out

    def reach(self, points: np.ndarray, down: int) -> tuple[np.ndarray, np.ndarray]:
        """(question, leaf) pairs that are not pruned."""
        found = [(who, np.full(len(who), node.number)) for node, who in search(self.root, points, np.arange(len(points)), down)]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))


def plan(words: DataFrame, part: int, sample: int) -> dict[int, Upper]:
    """Upper trees of the sizes that have more than one leaf, split on at most
    about ``sample`` words, chosen by hash."""
    total = words.count()
    share = min(1.0, sample / max(total, 1))
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.lit(round(share * (1 << 30)))).select("word")
    most = max(32, int(part * share))
    sizes = drawn.groupBy(F.char_length("word").alias("size")).count().where(F.col("count") > most).select("size")
    by_size: dict[int, list[str]] = {}
    for r in drawn.join(sizes, F.char_length("word") == F.col("size"), "left_semi").collect():  # at most ``sample`` words
        by_size.setdefault(len(r["word"]), []).append(r["word"])
    return {size: Upper(counts(letters(sorted(ws), size)), most) for size, ws in by_size.items()}


# ---- words in tasks

def _by_size(batch):
    ws = batch.column("word").to_pylist()
    n = batch.column("n").to_numpy(zero_copy_only=False)
    size = np.fromiter(map(len, ws), np.int64, len(ws))
    for s in np.unique(size):
        at = np.flatnonzero(size == s)
        for block in np.split(at, range(max(1, BLOCK // int(s)), len(at), max(1, BLOCK // int(s)))):
            yield int(s), [ws[k] for k in block], n[block]


def _placed(trees: dict[int, Upper]):
    """Each word's own leaf."""
    def run(batches):
        for batch in batches:
            for size, ws, n in _by_size(batch):
                tree = trees.get(size)
                at = tree.place(counts(letters(ws, size))) if tree else np.zeros(len(ws), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ws), size, np.int32)), pa.array(at.astype(np.int32)),
                                                  pa.array(ws, pa.string()), pa.array(n)], names=["size", "part", "word", "n"])
    return run


def _asking(trees: dict[int, Upper]):
    """Each word asks the leaves of its own size and of the next one."""
    def run(batches):
        for batch in batches:
            for size, ws, n in _by_size(batch):
                vectors, names = None, pa.array(ws, pa.string())
                for other, down in ((size, 1), (size + 1, 0)):
                    if tree := trees.get(other):
                        vectors = counts(letters(ws, size)) if vectors is None else vectors
                        who, leaf = tree.reach(vectors, down)
                    else:
                        who, leaf = np.arange(len(ws)), np.zeros(len(ws), int)
                    k = len(who)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(k, other, np.int32)), pa.array(leaf.astype(np.int32)), pa.array(np.zeros(k, bool)),
                                                      names.take(pa.array(who)), pa.array(n[who])], names=ASKED.fieldNames())
    return run


def one_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of symbols are one edit apart: of equal size with one
    letter replaced, or b one letter longer."""
    size = a.shape[1]
    if b.shape[1] == size:
        return (a != b).sum(axis=1) == 1
    front = np.logical_and.accumulate(a == b[:, :size], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= size


def neighbours(stored: np.ndarray, asked: np.ndarray, leaf: int = LEAF):
    """Blocks of (asked, stored) row numbers one edit apart; the rows hold
    symbols, those of ``asked`` as many or one fewer."""
    down = 1 if stored.shape[1] == asked.shape[1] else 0
    points, step = counts(stored), max(1, BLOCK // (4 * SYMBOLS))
    tree = build(points, np.arange(len(points)), leaf)
    as_float, length = points.astype(np.float64), (points.astype(np.float64) ** 2).sum(axis=1)
    for q in range(0, len(asked), step):
        mine = asked[q: q + step]
        question = counts(mine)
        q_float = question.astype(np.float64)
        q_length = (q_float ** 2).sum(axis=1)
        for node, who in search(tree, question, np.arange(len(mine)), down):
            for p in range(0, len(node.points), 1024):  # a leaf of equal vectors has no bound of its own
                at = node.points[p: p + 1024]
                square = q_length[who][:, None] + length[at] - 2 * (q_float[who] @ as_float[at].T)
                # whole numbers of equal or next sum: squared distance 2 (1) is L1 distance 2 (1)
                i, j = np.nonzero(square == 1 + down)
                for k in range(0, len(i), max(1, BLOCK // asked.shape[1])):
                    a, b = who[i[k: k + max(1, BLOCK // asked.shape[1])]], at[j[k: k + max(1, BLOCK // asked.shape[1])]]
                    good = one_apart(mine[a], stored[b])
                    if good.any():
                        yield q + a[good], b[good]


def _leaf_task(leaf: int):
    def run(table):
        is_stored = table.column("stored").to_numpy()
        ws, n = table.column("word").combine_chunks(), table.column("n").to_numpy()
        size = table.column("size")[0].as_py() if table.num_rows else 0
        mine = np.flatnonzero(is_stored)
        out = []
        if len(mine):
            stored = letters(ws.take(pa.array(mine)).to_pylist(), size)
            others = np.flatnonzero(~is_stored)
            length = np.fromiter(map(len, ws.take(pa.array(others)).to_pylist()), np.int64, len(others))
            for s in (size, size - 1):
                asking = others[length == s]
                if not len(asking):
                    continue
                for a, b in neighbours(stored, letters(ws.take(pa.array(asking)).to_pylist(), s), leaf):
                    a, b = asking[a], mine[b]
                    out.append((a, b))
                    if s < size:  # found from the shorter word only
                        out.append((b, a))
        a, b = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pa.table([ws.take(pa.array(a)), ws.take(pa.array(b)), pa.array(n[b])], names=PAIRS.fieldNames())
    return run


def near_pairs(words: DataFrame, part: int = PART, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """(word, near, near_n): all pairs of words one edit apart, both ways."""
    trees = plan(words, part, sample)
    placed = words.mapInArrow(_placed(trees), T.StructType([ASKED["size"], ASKED["part"], ASKED["word"], ASKED["n"]]))
    # leaves that hold more than planned are dealt by hash into several
    salts = placed.groupBy("size", "part").agg(F.ceil(F.count("*") / (4 * part)).cast("int").alias("salts"))
    salts = materialize(salts, name="spelling-leaves")
    stored = (placed.join(salts, ["size", "part"]).withColumn("salt", F.pmod(F.xxhash64("word"), "salts").cast("int"))
              .select("size", "part", F.lit(True).alias("stored"), "word", "n", "salt"))
    asked = (words.mapInArrow(_asking(trees), ASKED).join(salts, ["size", "part"])
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
             .select("size", "part", "stored", "word", "n", "salt"))
    return stored.unionByName(asked).groupBy("size", "part", "salt").applyInArrow(_leaf_task(leaf), PAIRS)


# ---- forms and roots

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: forms followed to the last.  A
    form's count is at least twice the word's, so chains are no longer than the
    logarithm of the largest count, and each round halves what is left."""
    now = materialize(forms.select("word", F.col("form").alias("root")), name="spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                   F.col("next").isNotNull().alias("moved")), name="spelling-roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: int = PART, sample: int = SAMPLE,
          leaf: int = LEAF) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all words of ``docs``.

    A null or empty text has no words and a null id reads as empty; repeated
    rows count as often as they come.  A word's form is the word one edit apart
    that occurs most (of equals the smallest in code-point order), if at least
    twice as often as the word; words without a form are their own root.
    """
    words = materialize(vocabulary(docs, doc_id, text), name="spelling-words")
    near = (near_pairs(words, part, sample, leaf).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    found = words.join(near, "word", "left")
    form = F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best.near"))
    found = materialize(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"),
                                     F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")), name="spelling-forms")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
