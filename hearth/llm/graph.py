"""Connected components over slim edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import cut


def _state(e: DataFrame):
    """Count and hash sum of the edges: two numbers that tell whether a round changed them."""
    return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` long edges -> ``(node, root)``: each node's smallest reachable node.

    Alternates a large-star and a small-star step until the edges no longer
    change.  Both steps are grouped minima and equi-joins, so a hub with very many
    neighbours is pre-aggregated and its join is splittable; nothing is
    collected.  The rounds grow with the logarithm of a component's size.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = cut(e)
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star on the larger end: link its smaller neighbours and itself to the least of them
        large = cut(large.filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        e = cut(small.filter("u <> v").distinct())
        now = _state(e)
        if now == state:
            break
        state = now
    stars = e.groupBy("u").agg(F.min("v").alias("root"))
    roots = stars.select(F.col("root").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stars.select(F.col("u").alias("node"), "root").unionByName(roots)
