"""Connected components of an edge table, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def smallest_labels(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge (``u``, ``v``): the smallest node it is connected to.

    Each step rewires edges towards smaller nodes by one aggregation and one equi-join on the edge's end, so no task
    holds the neighbours of a node, and a star's centre is an ordinary join key that AQE can split. The number of steps
    grows with the logarithm of the components' size. Each step is written to the shared folder.
    """
    e = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut_lineage(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        e = cut_lineage(small.where("u <> v").distinct())
        seen = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(
                e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        state = seen
