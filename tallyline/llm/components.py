"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (smallest node of it) for the nodes of ``links``
    (a, b). Every step hooks each node's links on its smallest neighbour; no
    node's neighbours are ever gathered, only their minimum. Each step is a
    written table, so a lost executor costs at most one step."""
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stage(pairs, "links")
    before = None
    while True:
        # large star: larger neighbours go to the smallest of all
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node's smaller neighbours, and itself, go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        pairs = stage(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
