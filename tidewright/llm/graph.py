"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.session import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of all nodes in `edges` (a, b); a component is named by its smallest node.

    Two steps in turn until nothing changes: every node links its larger neighbours to the smallest node
    it knows, then its smaller ones. Edges never grow in number, long chains shrink by halves, and a
    hub's least neighbour is found with partial sums; the joins are of a kind that Spark splits where one
    node has very many edges. Each round is a written table; only two numbers per round reach the driver.
    """
    a, b = F.col("a"), F.col("b")
    now = scratch.settle(edges.filter("a <> b").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seal = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or seal == tuple(mark):
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        seal = tuple(mark)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(first, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(
            first.select("u", F.col("m").alias("v"))).distinct()
        old, now = now, scratch.settle(small)
        scratch.drop(old)
