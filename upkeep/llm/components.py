"""Connected components of an edge table by alternating large-star and small-star steps.

Each step hangs the neighbours of a node below the smallest of them; both steps are a map-side combined minimum and a
join, whose hot nodes adaptive execution splits.  Nothing but two totals per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROUNDS = 100


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node of the component) for each node of ``a``, ``b`` with a link to another."""
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    pairs, before = pairs.checkpoint(), None
    for _ in range(MOST_ROUNDS):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        pairs = small.where("u > v").distinct().checkpoint()
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")
