"""Operator 8 (DataFrame only): mixing sources to target weights by systematic sampling.

Within a source every document expects ``target / source size`` copies. The expected copies
are summed in order of size, one random offset is added for the source, and a document is
emitted once for each integer boundary that its own share crosses. Neighbours in that order
have like sizes, so the words taken stay within a few documents of the target.

Null or empty texts have size 0 and a null source is a source of its own, ordered last; equal
rows are separate documents; an empty table gives an empty mix; other columns stay as they are.
The offset hangs on seed and source, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exonloom.scale import materialize

from .common import ordered_slabs, running_sums, seal

WEIGHTS = (1, 2, 3)


def targets(sizes: DataFrame, source: str, size: str, weights=WEIGHTS, most: int = 3) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows of ``source`` and ``size``.

    Sources in order of code points, null last, weigh ``weights`` in turn and share the sum of
    all sizes. No target exceeds ``most`` times its source's size; what is cut off is shared by
    weight among the others until none exceeds it. With sources in order of size per weight
    the full ones come first, so the final share per weight is the first that fits the next.
    """
    known = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    known = known.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place - 1, F.lit(len(weights))) + 1))
    by_room = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    fuller, whole = by_room.rowsBetween(W.unboundedPreceding, -1), by_room.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    limit = F.col("source_size") * float(most)
    left = F.sum("source_size").over(whole).cast("double") - most * F.coalesce(F.sum("source_size").over(fuller), F.lit(0)).cast("double")
    free = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(fuller), F.lit(0.0))
    known = known.withColumns({"limit": limit, "share": left / free})
    level = F.first(F.when(F.col("share") * F.col("weight") <= F.col("limit"), F.col("share")), ignorenulls=True).over(whole)
    return known.withColumn("level", level).select("source", "source_size", F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def offset(source, seed: int):
    """Start in [0, 1) of a source, from the first 32 bits of a digest."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def copies(docs: DataFrame, source: str = "source", size: str = "size", key: str = "doc_id", text: str | None = None, weights=WEIGHTS, most: int = 3, seed: int = 7) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies`` (0 to ``most``), one row per document.

    The order within a source is (size, key, text): equal rows share a place and are told apart only
    to count them. A source of any number of rows is cut into slabs and counted slab by slab.
    """
    docs, restore = seal(docs, source, size, key, *([text] if text else []))
    tie = F.xxhash64(*([text] if text else [key]))
    numbered = docs.withColumn("_place", F.struct(F.col(source).alias("source"), F.col(size).alias("size"), F.col(key).alias("key"), tie.alias("tie")))
    # only places are put in order; rows with their texts are dealt once, to meet their place
    lean = materialize(numbered.groupBy("_place").agg(F.count(F.lit(1)).alias("_n")).select("_place.*", "_n"), "places")
    goal = targets(lean.select("source", (F.col("size") * F.col("_n")).alias("size")), "source", "size", weights, most).withColumnRenamed("source", "_goal")
    order = ["source", "size", "key", "tie"]
    placed = running_sums(ordered_slabs(lean, order), order, ["source"], {"_upto": F.col("_n")})
    placed = placed.select(F.struct(*order).alias("_at"), (F.col("_upto") - F.col("_n")).alias("_before"))
    equal = W.partitionBy("_place").rowsBetween(W.unboundedPreceding, W.currentRow)
    met = numbered.join(placed, F.col("_place") == F.col("_at")).withColumn("_nth", F.col("_before") + F.count(F.lit(1)).over(equal))
    joined = met.join(goal, F.col(source).eqNullSafe(F.col("_goal")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = lambda n: F.floor(n * rate + offset(F.col(source), seed))
    return restore(joined.withColumn("copies", (upto(F.col("_nth")) - upto(F.col("_nth") - 1)).cast("int")), "source_size", "target", "copies")


def mix(docs: DataFrame, source: str = "source", size: str = "size", key: str = "doc_id", text: str | None = None, **how) -> DataFrame:
    """The mix itself: every document as many times as it is to be seen, columns of ``docs`` only."""
    own, restore = seal(docs, source, size, key, *([text] if text else []))
    counted = copies(own, source, size, key, text, **how).where("copies > 0")
    return restore(counted.select("*", F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")))
