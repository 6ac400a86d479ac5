"""Connected components of an edge table, by alternating star contractions.

Each round points every node at the smallest node it knows of. The larger half of a node's
neighbours moves first, then the smaller half, until nothing changes; the rounds needed grow with the
logarithm of the graph. Nodes and edges stay in tables; only one checksum a round is collected.
Minima are combined before the shuffle, and the joins are plain, so a hot node can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.tables import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """node and component, the smallest node reachable, of every node of the edges (a, b)."""
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = scratch.put(f"{name}-0", pairs)
    known, step = None, 0
    while True:
        both = pairs.union(pairs.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("low"))
        large = both.join(lowest, F.col("a") == F.col("n")).where("b > a AND b != low").select("b", "low").toDF("a", "b")
        large = large.distinct()
        lowest = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        small = large.join(lowest, F.col("a") == F.col("n")).where("b != low")
        moved = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(lowest.select("n", "low"))
        step += 1
        pairs = scratch.put(f"{name}-{step}", moved.distinct())
        scratch.drop(f"{name}-{step - 1}")
        state = pairs.select(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.countDistinct("a")
        ).first()
        if state == known or state[0] == state[2] and not _chained(pairs):
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        known = state


def _chained(pairs: DataFrame) -> bool:
    """Whether some node points at one that points further."""
    return not pairs.join(pairs.select(F.col("a").alias("n")), F.col("b") == F.col("n"), "left_semi").isEmpty()
