"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm._spark import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    leaves = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return leaves.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long): component is the smallest node reachable.

    Hot nodes are safe: minima are pre-aggregated and joined back, so no neighbourhood meets in one task.
    Self-loops and null ends are ignored; an empty table gives an empty result.
    """
    now = cut(edges.select("a", "b").where("a <> b").distinct())
    state = None
    while True:
        now = cut(_small_star(_large_star(now)))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
