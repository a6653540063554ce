"""Connected components of a large edge table by alternating large and small stars.

Every round joins the edges with the least neighbour of each node; a node with any number of
neighbours is one row of the aggregated side, so its edges may be split over tasks. Rounds are
cut by tables in the shared folder. Ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exonloom.scale import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (least node of it) for every node on an edge ``u, v``; loops are ignored.

    An empty edge table gives no rows.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "edges")
    seen = _state(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # now every edge points from the greater to the smaller node
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(least, F.col("u") == F.col("k")).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        e = materialize(small.select("e.*").where("u <> v").distinct(), "edges")
        now = _state(e)
        if now == seen:
            break
        seen = now
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return out.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
