"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import Tables, put


def components(edges: DataFrame, area: Tables, name: str) -> DataFrame:
    """``node, component`` (the smallest node) of every node in ``edges(a, b)``, longs.

    Alternating large-star and small-star steps: every node links its larger
    (then its smaller) neighbours to the smallest one it knows, until nothing
    changes, about ``log(n)`` rounds.  A hub with any number of neighbours is
    aggregated to its minimum before it is joined back, and each step is a
    written table.
    """
    first = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    current = put(area, first.distinct(), f"{name}-edges")
    step = 0
    while True:
        step += 1
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = put(area, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), f"{name}-low{step}")
        large = both.filter("v > u").join(lows, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = put(area, large.filter("u <> v").distinct(), f"{name}-large{step}")
        mins = put(area, large.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n")), f"{name}-min{step}")
        # Done when the edges are stars: every node has one parent, and no parent has one.
        chained = large.join(mins.select(F.col("u").alias("v")), "v", "left_semi")
        if mins.filter("n > 1").isEmpty() and chained.isEmpty():
            stars = large.select(F.col("u").alias("node"), F.col("v").alias("component"))
            roots = large.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return stars.union(roots)
        joined = large.join(mins, "u")
        small = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).union(joined.select("u", F.col("low").alias("v")))
        current = put(area, small.filter("u <> v").distinct(), f"{name}-small{step}")
