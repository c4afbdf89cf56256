"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node points its larger neighbours to the smallest node it sees."""
    seen = _both_ways(edges)
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("_m"))
    # distinct here spreads what many nodes send to one before that one gathers it
    return seen.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node points its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return moved.union(least.select("a", F.col("_m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long) that is not its own root.

    The root is the smallest node that can be reached. Each round is written to the shared
    folder; only a count and a checksum of the edges come to the driver. Rounds grow with
    the logarithm of the largest component, and joins are split by AQE where a node is hot.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct())
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        now = written(_small_star(_large_star(now)))
