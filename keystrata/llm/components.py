"""Connected components of links, in rounds of grouping; nothing is gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystrata.session import released, written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node that links reach) for every node of the links ``a``, ``b`` (longs).

    Alternating star steps: every node points its neighbours at the smallest node near it, first the larger ones,
    then all at once, until nothing changes. Each round's links are written, so a lost executor costs one round at
    most. A node with very many links gets partial minima before rows are moved; after a round it is a star.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    while True:
        # Large star: neighbours above a node go to the smallest node near it.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: the node and its smaller neighbours go to the smallest of them.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        after = written(small.select("e.u", "e.v").filter("u <> v").distinct(), "components")
        changed = after.count() != edges.count() or not after.join(edges, ["u", "v"], "left_anti").isEmpty()
        released(edges)
        edges = after
        if not changed:
            break
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
