"""Connected components of a link table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import freeze


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node that has a link; ``component`` is the smallest node reachable.

    Large-star and small-star steps alternate until the links are stars around the smallest nodes, which takes
    about a logarithm of the longest path. Every step combines links per node before it shuffles them and is written
    to the shared folder. No group of links meets in one task: the joins back to a hub can be split.
    NULL ends and links of a node with itself are left out; no links give no rows.
    """
    e = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e = freeze(e, "links")
    before = _state(e)
    while before[0]:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", "m")).distinct())
        e = freeze(small, "links")
        now = _state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
