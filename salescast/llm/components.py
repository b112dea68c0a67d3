"""Connected components of an edge table, by large-star and small-star rounds.

Each round is one grouped job; its result is written to the shared folder, so
lineage stays short and a lost executor re-reads files.  Edges never reach the
driver: it sees one number a round, a checksum that stops the loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.session import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are hung under the least of its neighbourhood."""
    all_ = _both(edges)
    least = all_.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("least"))
    return (all_.where(F.col("dst") > F.col("src")).join(least, "src")
            .select(F.col("dst").alias("src"), F.col("least").alias("dst")).where("src <> dst").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung under the least of them."""
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("least"))
    moved = down.join(least, "src")
    return (moved.select(F.col("dst").alias("src"), F.col("least").alias("dst"))
            .unionByName(least.select("src", F.col("least").alias("dst"))).where("src <> dst").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge, root being the smallest node of
    its component; (node, node) pairs and repeated edges do no harm."""
    now = materialize(edges.where("src <> dst").distinct(), name="cc-0")
    seen, k = None, 0
    while True:
        sign = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("src", "dst")).alias("x")).first()
        if sign["n"] == 0 or sign == seen:
            break
        seen, k = sign, k + 1
        now = materialize(_small_star(_large_star(now)), name=f"cc-{k}")
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(roots)
