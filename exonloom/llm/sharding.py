"""Operator 6 (DataFrame only): consistent-hash ring with virtual nodes and bounded loads.

Shards own many virtual nodes on a ring of ``CELLS`` places. A row goes clockwise to the next
node; its shard keeps the rows of its own arcs, in ring order, up to its capacity. The rest
goes on clockwise, first come first served, to the next nodes whose shard still has room.
Capacities add up to (1 + slack) times the whole load, so after two laps every row has a place.
A shard that is added takes over some arcs, and the others give way only at the end of what
they keep, so few rows move.

All of this is worked out on the loads of the arcs, a table of fixed size: which stretch of
each arc ends up in which shard (``stretches``). A row then needs only its running load in ring
order, which is taken slab by slab, so no key, shard or cell has to fit into a task.

A load of 1 for each row and no slack give the law ``rows``: counts differ by one at most.
Sizes as loads give the law ``bytes``, up to the rows that fill a shard; slack then trades
balance for fewer moved rows. Null text is an empty one; equal rows are placed one after the
other; an empty table gives no rows; other columns have no part in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exonloom.scale import materialize

from .common import ordered_slabs, running_sums, seal

CELLS = 1 << 14


def ring(spark, shards: int, nodes: int) -> DataFrame:
    """All cells in ring order with the number (from 0) of the next node clockwise, and all nodes with their shard.

    Returns ``cell, node`` for the cells; node numbers count along the ring and the last cells,
    which no node follows, belong to node 0 one lap on (number ``shards * nodes``).
    """
    cells = spark.range(CELLS).select(F.col("id").alias("cell"), F.lit(0).alias("of_node"))
    ahead = W.orderBy("cell", "of_node").rowsBetween(W.unboundedPreceding, -1)
    known = _nodes(spark, shards, nodes).select("cell", F.lit(1).alias("of_node"))
    # a cell stands before the nodes of its own place, so it counts those that it has passed
    both = cells.unionByName(known).withColumn("node", F.coalesce(F.sum("of_node").over(ahead), F.lit(0)))
    return both.where("of_node = 0").select("cell", "node")


def _nodes(spark, shards: int, nodes: int) -> DataFrame:
    each = spark.range(shards * nodes).select(F.floor(F.col("id") / nodes).cast("int").alias("shard"), F.pmod("id", F.lit(nodes)).cast("int").alias("v"))
    return each.withColumn("cell", F.pmod(F.xxhash64(F.lit("node"), "shard", "v"), F.lit(CELLS)))


def arcs(spark, shards: int, nodes: int, per_cell: DataFrame, slack: float) -> DataFrame:
    """What each node's arc brings: ``arc, shard, load, begin`` (load of earlier arcs), ``own`` (that of earlier arcs of
    its shard), ``cap`` (what its shard may hold), ``over`` (what its shard passes on) and ``passed`` (that of earlier arcs).

    ``per_cell``: ``cell, load``. The cells after the last node are an arc of their own, which belongs to node 0.
    """
    numbered = _nodes(spark, shards, nodes).withColumn("arc", F.row_number().over(W.orderBy("cell", "shard", "v")) - 1).select("arc", "shard")
    ends = numbered.unionByName(numbered.where("arc = 0").withColumn("arc", F.lit(shards * nodes)))
    loads = ring(spark, shards, nodes).join(per_cell, "cell").groupBy(F.col("node").alias("arc")).agg(F.sum("load").alias("load"))
    earlier = lambda *keys: W.partitionBy(*(keys or [F.lit(0)])).orderBy("arc").rowsBetween(W.unboundedPreceding, -1)
    before = lambda c, *keys: F.coalesce(F.sum(c).over(earlier(*keys)), F.lit(0))
    sized = ends.join(loads, "arc", "left").withColumn("load", F.coalesce("load", F.lit(0).cast("long")))
    whole = F.sum("load").over(W.partitionBy(F.lit(0)))
    sized = sized.withColumn("whole", (F.ceil(whole * (1 + slack)) if slack else whole).cast("long"))
    sized = sized.withColumns({"begin": before("load"), "own": before("load", "shard"), "cap": F.expr(f"whole div {shards} + if(shard < whole % {shards}, 1, 0)")})
    sized = sized.withColumn("over", F.greatest(F.lit(0), F.col("own") + F.col("load") - F.greatest("cap", "own")))
    return sized.withColumn("passed", before("over")).drop("whole")


def stretches(around: DataFrame, shards: int) -> DataFrame:
    """``arc, lo, hi, shard``: where the loads of an arc go that lie from ``lo`` to ``hi`` in its own shard's running load.

    One fold over two laps of the ring carries what waits for a place and the room left in each shard; it
    keeps a row for each time that a shard takes some. Cutting the sequence of the loads passed on at the
    arcs and at these takings gives the stretches.
    """
    kept = around.where("load > over").select("arc", F.col("own").alias("lo"), F.least(F.col("own") + F.col("load"), "cap").alias("hi"), "shard")
    room = around.groupBy("shard").agg(F.greatest(F.max("cap") - F.sum("load"), F.lit(0)).alias("room"))
    start = room.agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "room"))), lambda x: x["room"]).alias("rooms"))
    visits = around.agg(F.array_sort(F.collect_list(F.struct("arc", "shard", "over"))).alias("lap"))
    walk = visits.withColumn("rooms", start.scalar()).select(F.expr("""aggregate(
        concat(lap, transform(lap, x -> named_struct('arc', x.arc, 'shard', x.shard, 'over', 0L))),
        named_struct('waits', 0L, 'given', 0L, 'rooms', rooms, 'takes', array_remove(array(named_struct('at', 0L, 'shard', 0)), named_struct('at', 0L, 'shard', 0))),
        (s, x) -> transform(array(named_struct('w', s.waits + x.over, 'n', least(s.waits + x.over, s.rooms[x.shard]))), y -> if(y.n = 0L,
            named_struct('waits', y.w, 'given', s.given, 'rooms', s.rooms, 'takes', s.takes),
            named_struct('waits', y.w - y.n, 'given', s.given + y.n, 'rooms', transform(s.rooms, (r, i) -> if(i = x.shard, r - y.n, r)),
                         'takes', concat(s.takes, array(named_struct('at', s.given, 'shard', x.shard))))))[0],
        s -> s.takes)""").alias("takes"))
    takes = walk.select(F.posexplode("takes").alias("nth", "t")).select(F.col("t.at").alias("at"), F.struct("nth", "t.shard").alias("take"), F.lit(None).cast("struct<arc:int,base:bigint>").alias("from"))
    cuts = around.where("over > 0").select(F.col("passed").alias("at"), F.lit(None).cast("struct<nth:int,shard:int>").alias("take"),
                                           F.struct(F.col("arc"), (F.greatest("cap", "own") - F.col("passed")).alias("base")).alias("from"))
    along = W.partitionBy(F.lit(0)).orderBy("at", F.col("take").isNull())
    points = takes.unionByName(cuts).withColumns({"next": F.coalesce(F.lead("at").over(along), F.lit(around.agg(F.sum("over")).scalar())),
                                                  "take": F.last("take", True).over(along.rowsBetween(W.unboundedPreceding, W.currentRow)),
                                                  "from": F.last("from", True).over(along.rowsBetween(W.unboundedPreceding, W.currentRow))})
    moved = points.where("next > at").select(F.col("from.arc").alias("arc"), (F.col("at") + F.col("from.base")).alias("lo"), (F.col("next") + F.col("from.base")).alias("hi"), F.col("take.shard").alias("shard"))
    return kept.unionByName(moved)


def assign(docs: DataFrame, key: tuple[str, ...] = ("doc_id",), load: str | None = None, shards: int = 40, nodes: int = 64, slack: float = 0.0) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (gapless from 0 within the shard).

    ``load``: column of what a row weighs (long, at least 1), or None where each weighs 1.
    """
    spark = docs.sparkSession
    docs, restore = seal(docs, *key, *([load] if load else []))
    place = F.xxhash64(F.lit("row"), *key)
    placed = docs.withColumns({"_place": place, "_cell": F.pmod(F.shiftrightunsigned(place, 20), F.lit(CELLS)), "_row": F.monotonically_increasing_id(),
                               "_load": F.lit(1).cast("long") if load is None else F.col(load).cast("long")})
    order = ["_cell", "_place", "_row"]
    slabs = ordered_slabs(placed, order)
    upto = running_sums(slabs, order, [], {"_upto": F.col("_load"), "_nth": F.lit(1).cast("long")})

    per_cell = materialize(slabs.groupBy(F.col("_cell").alias("cell")).agg(F.sum("_load").alias("load")), "cells")
    around = materialize(arcs(spark, shards, nodes, per_cell, slack), "arcs")
    parts = materialize(stretches(around, shards), "stretches")
    # both tables have a size that the ring sets: a row for each cell, at most four for each node
    cells = ring(spark, shards, nodes).select(F.col("cell").alias("_c"), F.col("node").alias("_arc")).join(around.select(F.col("arc").alias("_arc"), (F.col("own") - F.col("begin")).alias("_lead")), "_arc")
    at = upto.join(F.broadcast(cells), F.col("_cell") == F.col("_c")).withColumn("_at", F.col("_upto") - F.col("_load") + F.col("_lead"))
    at = at.join(F.broadcast(parts), (F.col("_arc") == F.col("arc")) & (F.col("lo") <= F.col("_at")) & (F.col("_at") < F.col("hi")))
    # rows of one stretch follow each other in ring order
    runs = at.groupBy(F.col("arc").alias("_ra"), F.col("lo").alias("_rl"), F.col("shard").alias("_rs")).agg(F.count(F.lit(1)).alias("n"), F.min("_nth").alias("_first"))
    earlier = W.partitionBy("_rs").orderBy("_ra", "_rl").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select("_ra", "_rl", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    out = at.join(F.broadcast(runs), (F.col("arc") == F.col("_ra")) & (F.col("lo") == F.col("_rl"))).withColumn("slot", F.col("_nth") + F.col("_shift"))
    return restore(out, "shard", "slot")
