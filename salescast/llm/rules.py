"""Quality rules with risk-controlled thresholds; DataFrame functions only.

Each rule rejects a document whose statistic is above a cutoff.  Cutoffs come
from a labelled holdout of clean documents: in each stratum, the false
rejections of each candidate cutoff are counted, and a cutoff is certified if
an exact binomial test rejects "it takes ``risk`` / rules of the clean documents
or more" at level ``delta`` / tests (Bonferroni over strata, rules and
candidates).  The strictest certified cutoff is used; a rule without one is not
used in the stratum.  So with probability 1 - delta no stratum loses more than
``risk`` of its clean documents to the rules.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm import text as tx
from salescast.session import materialize

#: Candidate cutoffs of each rule, from lenient to strict.
CUTOFFS = {
    "symbol_ratio": (0.5, 0.3, 0.2, 0.1, 0.05),
    "dup_line_ratio": (0.7, 0.5, 0.4, 0.3, 0.2),
    "repeat_ratio": (0.45, 0.4, 0.35, 0.3, 0.25),
    "upper_ratio": (0.7, 0.5, 0.4, 0.3, 0.2),
}
RISK, DELTA = 0.05, 0.05
#: The base rules: least words, and most repeated words a hundred.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS, SPACES = "#*$%&|<>", "\t\n\x0b\x0c\r"


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its text replaced by n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_lines and n_upper, computed within the row.

    Repeated 3-word windows are found by sorting a text's windows with their
    places (only where a window is repeated at all), so that a text of n words
    costs n log n.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    body = F.coalesce(F.col(text), F.lit(""))
    plain = F.translate(body, SPACES, " " * len(SPACES))
    w = F.array_remove(F.split(plain, " "), "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, SPACES + " ", "")) > 0)
    step = docs.select(*rest, F.length(F.translate(plain, " ", "")).cast("bigint").alias("word_chars"),
                       (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
                       (F.length(body) - F.length(F.translate(body, tx.ASCII_UPPER, ""))).cast("bigint").alias("n_upper"),
                       w.alias("_w"), lines.alias("_lines"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text] + [F.col(c) for c in ("word_chars", "n_symbols", "n_upper")]
    n = F.size("_w")
    window = F.transform(F.slice("_w", F.lit(1), F.greatest(n - 2, F.lit(0))),
                         lambda x, i: F.concat_ws(" ", x, F.col("_w")[i + 1], F.col("_w")[i + 2]))
    step = step.select(*kept, n.cast("bigint").alias("n_words"), F.size("_lines").cast("bigint").alias("n_lines"),
                       (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"), window.alias("_win"))
    kept += [F.col(c) for c in ("n_words", "n_lines", "n_dup_lines")]
    placed = F.sort_array(F.transform("_win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    step = step.select(*kept, F.when(F.size(F.array_distinct("_win")) < F.size("_win"), placed).otherwise(F.slice(placed_none(), 1, 0)).alias("_s"))
    s, last = F.col("_s"), F.size("_s") - 1
    same = lambda x, j: ((j > 0) & (F.get(s, j - 1)["x"] == x["x"])) | ((j < last) & (F.get(s, j + 1)["x"] == x["x"]))
    step = step.select(*kept, F.transform(F.filter("_s", lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["i"]).alias("_i"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("sum"))
    cover = F.aggregate(F.sort_array("_i"), start, lambda a, i: F.struct(
        (i + 3).alias("end"), (a["sum"] + i + 3 - F.greatest(i, a["end"])).alias("sum")), lambda a: a["sum"])
    return step.select(*kept, cover.alias("n_repeat_words"))


def placed_none() -> Column:
    return F.array(F.struct(F.lit("").alias("x"), F.lit(0).alias("i")))


def ratios() -> dict[str, Column]:
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {"symbol_ratio": share("n_symbols", "word_chars"), "dup_line_ratio": share("n_dup_lines", "n_lines"),
            "repeat_ratio": share("n_repeat_words", "n_words"), "upper_ratio": share("n_upper", "word_chars")}


def log_factorial(x: Column) -> Column:
    """ln x! of whole numbers: Stirling's series at x + 9, where its next term is
    below 1e-11, less the logs of the eight factors above x."""
    z = x.cast("double") + F.lit(9.0)
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5)) - 1 / (1680 * F.pow(z, 7))
    above = F.lit(0.0)
    for i in range(1, 9):
        above = above + F.log(x.cast("double") + i)
    return series - above


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= k) for k below n * p (else 0, its bound): the log of the
    k-th term, and the sum of the terms below relative to it.

    Going down from k, the m-th term is below exp(-m^2 / 2np) of the first, so the
    terms beyond 9 * sqrt(np) + 60 add nothing to a double: the array of steps
    grows with the root of n, and nothing is left out that could be seen."""
    steps = F.least(k, F.ceil(9 * F.sqrt(n * p)) + 60)
    down = F.when(steps > 0, F.sequence(F.lit(0).cast("bigint"), steps - 1)).otherwise(F.array().cast("array<bigint>"))
    choose = log_factorial(n) - log_factorial(k) - log_factorial(n - k)
    fall = lambda a, j: a["term"] * (k - j) / (n - k + j + 1) * ((1 - p) / p)
    tail = F.aggregate(down, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
                       lambda a, j: F.struct(fall(a, j).alias("term"), (a["sum"] + fall(a, j)).alias("sum")), lambda a: F.log(a["sum"]))
    return F.when(k < n * p, choose + k * math.log(p) + (n - k) * math.log1p(-p) + tail).otherwise(0.0)


def candidates(rows: DataFrame, stratum: str, cutoffs=None, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, n, k, certified) from rows of clean documents."""
    cutoffs = CUTOFFS if cutoffs is None else cutoffs
    value = ratios()
    each = [F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"), (value[r] > c).cast("bigint").alias("hit"))
            for r, cs in cutoffs.items() for c in cs]
    counted = (rows.select(stratum, F.explode(F.array(*each)).alias("e")).groupBy(stratum, "e.rule", "e.cutoff")
               .agg(F.count("*").alias("n"), F.sum("e.hit").alias("k")))
    tests = counted.agg(F.greatest(F.count("*"), F.lit(1)).cast("double").alias("m"))
    bound = log_binomial_cdf(F.col("k"), F.col("n"), risk / len(cutoffs))
    return counted.withColumn("certified", bound <= F.log(F.lit(delta) / tests.scalar()))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang",
          cutoffs=None, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, rejected_by) for each row of ``docs``.

    The holdout is every row whose id ``labels`` marks with quality 1 (an id
    that is marked both ways is not clean).  A null text has no words and fails
    the base rules; a null stratum is the stratum ``und``; rows with null ids
    are judged but never in the holdout; repeated rows count as often as they
    come.  Without labels no cutoff is certified and only the base rules hold.
    """
    cutoffs = CUTOFFS if cutoffs is None else cutoffs
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(stratum), F.lit("und")).alias("stratum"))
    rows = materialize(statistics(slim), name="rules")
    clean = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    chosen = candidates(rows.join(clean, "doc_id", "left_semi"), "stratum", cutoffs, risk, delta).where("certified")
    limits = chosen.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_{r}") for r in cutoffs])
    value = ratios()
    hit = F.filter(F.array(*[F.when(value[r] > F.col(f"_{r}"), F.lit(r)) for r in cutoffs]), lambda x: x.isNotNull())
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (rows.join(limits, "stratum", "left").withColumn("rejected_by", hit).withColumn("base_failed", failed)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"), F.array_join("rejected_by", ",").alias("rejected_by")))
