"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time u in [0, 1]:
w(u) = target * (1 + slope * (2u - 1)).  Its integral is the demand for the
source's words up to time u, target * (u + slope * (u^2 - u)); a document that
starts at a given number of words of its source is trained on at the time u at
which the demand reaches that number.  Positions of all sources are then one
order, in which documents are range-sorted.

Nothing is gathered by source in one task: words are summed per (source, slot),
slots being hashes of the documents, and only the sums are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm import text as tx
from salescast.operators.keys import dense_keys
from salescast.session import materialize

#: Weights of the sources in code point order, and the slopes of their
#: schedules; both repeat.
WEIGHTS, SLOPES = (3.0, 1.0, 2.0), (0.6, 0.0, -0.6)
#: Words to mix, as a share of all words; most passes over a source.
SHARE, EPOCHS = 1.5, 2.0
#: Rows of all sources together that fall into one slot.
SLOT_ROWS = 2048


def targets(sizes: DataFrame, share: float = SHARE, epochs: float = EPOCHS,
            weights=WEIGHTS, slopes=SLOPES) -> DataFrame:
    """(source, source_size, target, slope) from (source, source_size).

    Sources share ``share`` of all words by weight; a target stops at
    ``epochs`` times its source's size, and what is above is shared out again
    by weight until none is above.  One aggregate a pass; passes end when no
    further source reaches its limit.
    """
    ranked = dense_keys(sizes.select("source").where(F.col("source").isNotNull()), "source", "rank", start=0)
    n = ranked.count()
    cycle = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("rank") % len(values) + 1).cast("int"))
    all_ = (sizes.join(ranked, "source", "left").withColumn("rank", F.coalesce(F.col("rank"), F.lit(n)))
            .select("source", "source_size", (F.col("source_size") * epochs).alias("limit"),
                    cycle(weights).alias("weight"), cycle(slopes).alias("slope")))
    all_ = materialize(all_, name="mix-sources")
    total = all_.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    rate, full = 0.0, F.lit(False)
    while True:
        got = all_.agg(F.sum(F.when(full, F.col("limit")).otherwise(0.0)).alias("fixed"),
                       F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
                       F.sum(F.when(full, 1).otherwise(0)).alias("n")).first()
        if not got["open"]:
            rate = float("inf")
            break
        next_rate = (share * total - got["fixed"]) / got["open"]
        if next_rate == rate:
            break
        rate = next_rate
        full = F.col("limit") < F.col("weight") * rate
    return all_.select("source", "source_size", F.least(F.col("limit"), F.col("weight") * rate).alias("target"), "slope")


def position(offset: Column, target: Column, slope: Column) -> Column:
    """Time at which target * (u + slope * (u^2 - u)) reaches ``offset``."""
    x = F.try_divide(offset, target)
    linear = 1 - slope
    root = F.sqrt(linear * linear + 4 * slope * x)
    return F.least(F.lit(1.0), F.when(F.abs(slope) < 1e-12, x).otherwise(2 * x / (linear + root)))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", share: float = SHARE,
        epochs: float = EPOCHS, weights=WEIGHTS, slopes=SLOPES, keep: bool = False) -> tuple[DataFrame, DataFrame]:
    """Occurrences of documents in the mix, and a report of every document.

    The first frame has one row for each pass that takes words of a document:
    doc_id, source, size, epoch, taken (words; the last document of a target
    is cut there) and position in [0, 1], range-sorted by position; with
    ``keep``, all columns of ``docs`` and epoch, taken, position.  The second has doc_id, size,
    source_size, target, taken for every row of ``docs``.

    A null text has no words and takes none; null is a source of its own, the
    last; rows with a null or a repeated id are mixed as rows of their own; an
    empty table gives empty frames.  The order within a source follows a hash
    of the id, so reruns agree.
    """
    placed, passes = _placed(docs, doc_id, source, text, share, epochs, weights, slopes, keep)
    report = placed.select("doc_id", "size", "source_size", "target", sum((t for _, t in passes[1:]), passes[0][1]).alias("taken"))
    mixed = _dealt(placed, passes)
    if keep:
        names = {f: tx.fresh(f, docs.columns) for f in ("epoch", "taken", "position")}
        out = mixed.select("row.*", *[F.col("o")[f].alias(c) for f, c in names.items()])
        out = out.orderBy(names["position"], f"`{doc_id}`", names["epoch"])
    else:
        out = mixed.select("doc_id", "source", "size", "o.epoch", "o.taken", "o.position").orderBy("position", "doc_id", "epoch")
    return out, report


def deal(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", share: float = SHARE,
         epochs: float = EPOCHS, weights=WEIGHTS, slopes=SLOPES) -> tuple[DataFrame, DataFrame]:
    """The occurrences as a table written in the order of their positions, and
    a report of every document that is summed up from that table.

    The first frame has the columns of ``mix`` and ``row``, a number of the
    document's row; the second has row, doc_id, size, source_size, target,
    taken, occurrences, first_position and last_position (null if nothing of
    the document is taken) for every row of ``docs``.
    """
    placed, passes = _placed(docs, doc_id, source, text, share, epochs, weights, slopes)
    placed = materialize(placed.withColumn("row", F.monotonically_increasing_id()), name="mix-placed")
    out = (_dealt(placed, passes).select("row", "doc_id", "source", "size", "o.epoch", "o.taken", "o.position")
           .orderBy("position", "doc_id", "epoch"))
    out = materialize(out, name="mix-occurrences")
    sums = out.groupBy("row").agg(F.sum("taken").alias("taken"), F.count("*").alias("occurrences"),
                                  F.min("position").alias("first_position"), F.max("position").alias("last_position"))
    report = sums.join(placed.select("row", "doc_id", "size", "source_size", "target"), "row", "right").select(
        "row", "doc_id", "size", "source_size", "target", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("taken", "occurrences")],
        "first_position", "last_position")
    return out, report


def _dealt(placed: DataFrame, passes) -> DataFrame:
    """A row with a struct ``o`` for each pass that takes words of a row."""
    each = F.array(*[F.struct(F.lit(k + 1).alias("epoch"), t.alias("taken"),
                              position(s.cast("double"), F.col("target"), F.col("slope")).alias("position"))
                     for k, (s, t) in enumerate(passes)])
    return placed.withColumn("o", F.explode(F.filter(each, lambda o: o["taken"] > 0)))


def _placed(docs, doc_id, source, text, share, epochs, weights, slopes, keep=False):
    """Each row of ``docs`` with its offset in the words of its source, and for
    each pass the columns of its start and of the words taken."""
    size = F.size(tx.words(F.col(text))).cast("bigint")
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), key.alias("h"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep else []))
    slim = materialize(base.select("doc_id", "source", "size", "h"), name="mix-docs")
    n = slim.count()
    slots = max(1, -(-n // SLOT_ROWS))
    # the leading 32 bits of the hash, cut into equal ranges: slots are in hash order
    slot = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint") * slots / 2.0**32).cast("bigint")
    sums = materialize(slim.groupBy("source", slot.alias("slot")).agg(F.sum("size").alias("words")), name="mix-slots")
    goal = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), share, epochs, weights, slopes)
    before = F.sum("words").over(Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("source", "slot", F.coalesce(before, F.lit(0)).alias("lead"))
    sums = (sums.alias("a").join(goal.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
            .select(F.col("a.source").alias("s"), "a.slot", "lead", "source_size", "target", "slope"))
    rows = (base if keep else slim).withColumn("slot", slot)
    placed = (rows.join(sums, rows["source"].eqNullSafe(sums["s"]) & (rows["slot"] == sums["slot"]))
              .select(*[rows[c] for c in rows.columns], "lead", "source_size", "target", "slope"))
    inside = F.sum("size").over(Window.partitionBy("source", "slot").orderBy("h", "doc_id", "size")
                                .rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("offset", F.col("lead") + F.coalesce(inside, F.lit(0)))
    starts = [F.col("offset") + k * F.col("source_size") for k in range(int(-(-epochs // 1)))]
    return placed, [(s, F.greatest(F.lit(0), F.least(F.col("size"), F.floor(F.col("target")) - s)).cast("bigint")) for s in starts]
