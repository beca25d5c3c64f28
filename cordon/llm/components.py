"""Connected components of a link table, by alternating large and small stars (Kiveris and others, 2014).

Every step is a minimum per node (summed before the shuffle) and a join, so a node with very many links
is split like any other skewed join; no component is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm.scratch import discard, written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or not larger) neighbours on the smallest node around it."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b <= a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.join(least, "a")
    out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else \
        moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node with a link to another; ``root`` is the component's smallest node."""
    now = written(links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "links")
    mark = None
    while True:
        before, now = now, written(_star(_star(now, True), False), "stars")
        discard(before)
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = state
