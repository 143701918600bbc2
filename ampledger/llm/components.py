"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampledger.llm.scratch import stage

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """Columns node and label (the smallest node of its component) for all nodes of ``edges`` (a, b; long).

    Alternates the large-star and small-star steps until nothing changes.
    Minima are aggregated before the shuffle, and joins of a node with many
    edges can be split, so that a hub doesn't become one task.
    """
    now = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())
        seen = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")
        up = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stage(up.filter("a <> b").distinct(), "stars")
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")), "stars")
        down = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(down.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
