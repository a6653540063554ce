"""Building blocks that keep the operators safe on skewed, very large inputs.

* ``materialize`` cuts lineage by writing a table to the shared folder.
* ``Slabs`` evaluates running sums / maxima / last values over one huge key (or
  over no key at all) without ever sending that key to a single task.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SMALL_ROWS = 1_000_000
SMALL_CONF = "spark.exonloom.smallRows"
FEW_KEYS = 64   # a key with more than this part of the rows would leave tasks idle


def work_dir(spark: SparkSession) -> str:
    """Shared scratch folder: the cluster's checkpoint folder; one of our own in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.exonloom.localDir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.exonloom.localDir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str = "t") -> str:
    return f"{work_dir(spark)}/exonloom-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write to the shared folder and read back; survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Deletes the scratch tables that ``df`` reads, once its result is stored elsewhere."""
    spark = df.sparkSession
    base = work_dir(spark).split(":", 1)[-1].lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base in folder and "/exonloom-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Adds the columns of a one-row table through one scalar subquery, not a join."""
    packed = df.withColumn("_row", one_row.select(F.struct(*one_row.columns)).scalar())
    return packed.select(*df.columns, *[F.col(f"_row.{c}").alias(c) for c in one_row.columns])


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a plain scan over all cores when it has fewer splits than cores.

    Large inputs already have far more splits than cores and stay as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def computed_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Adds an expensive column behind a one-element generator.

    Catalyst neither merges projections nor pushes filters through a generator, so
    the expression is evaluated once per row however often ``name`` is used later.
    """
    return df.select("*", F.explode_outer(F.array(expr)).alias(name))


class Slabs:
    """Running aggregates over ``keys`` in ``order`` for keys of any size.

    The input is written once and its rows are counted there. Up to a million rows
    an ordinary window does, and also where no key has more rows than that and none
    holds a large share of the table. Else rows are range-partitioned by (keys, order)
    and written with their slab number, so that a hot key is cut into many slabs; every
    slab is scanned on its own and then shifted by the carry of the slabs before it (``next``:
    behind it). At most one key of a slab started in an earlier slab and one goes on in a later
    one, so the carry table never has more than two rows a slab.
    ``order`` must be a total order within ``keys``; with ``distinct`` equal rows are one, which
    takes no shuffle of its own where the keys are scanned whole.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list, distinct: bool = False):
        self.keys = list(keys)
        self.order = [F.col(o) if isinstance(o, str) else o for o in order]
        df = materialize(df, "scan")
        rows, most = df.count(), int(df.sparkSession.conf.get(SMALL_CONF, str(SMALL_ROWS)))
        self.single = rows <= most
        if not self.single and self.keys:
            largest = df.groupBy(*self.keys).count().agg(F.max("count")).first()[0]
            self.single = largest <= min(most, rows // FEW_KEYS)
        if distinct:
            df = (df.repartition(*self.keys) if self.single and self.keys else df).distinct()
        if self.single:
            self.df = df.withColumn("_slab", F.lit(0))
        else:
            cols = [F.col(k) for k in self.keys] + self.order
            ranged = df.repartitionByRange(*cols)
            self.df = materialize(ranged.withColumn("_slab", F.spark_partition_id()), "slab")

    def scan(self, *specs) -> "Slabs":
        """``specs``: (output, kind, expression, inclusive); kind is sum, max, last or next.

        ``last`` is the last non-null value, ``next`` the first one from here on; a missing
        prefix gives 0 for sum and null otherwise.
        """
        # without slabs the keys alone are grouped by, and a following group by them needs no shuffle
        part = self.keys if self.single and self.keys else ["_slab"] + self.keys
        base = W.partitionBy(*part).orderBy(*self.order)
        incl = base.rowsBetween(W.unboundedPreceding, W.currentRow)
        excl = base.rowsBetween(W.unboundedPreceding, -1)
        df = self.df
        for i, (_, _, expr, _) in enumerate(specs):
            df = df.withColumn(f"__v{i}", F.lit(expr) if not isinstance(expr, Column) else expr)
        src = df
        for i, (out, kind, _, inclusive) in enumerate(specs):
            win = incl if inclusive else excl
            v = F.col(f"__v{i}")
            if kind == "next":
                behind = F.expr(f"lead(__v{i}) ignore nulls").over(base)
                df = df.withColumn(out, F.coalesce(v, behind) if inclusive else behind)
                continue
            agg = {"sum": F.sum(v), "max": F.max(v), "last": F.last(v, ignorenulls=True)}[kind]
            df = df.withColumn(out, agg.over(win))
        if self.single:
            for i, (out, kind, _, _) in enumerate(specs):
                if kind == "sum":
                    df = df.withColumn(out, F.coalesce(out, F.lit(0)))
            self.df = df.drop(*[f"__v{i}" for i in range(len(specs))])
            return self
        aggs = []
        kinds = {kind for _, kind, _, _ in specs}
        if kinds & {"last", "next"}:
            src = src.withColumn("__rn", F.row_number().over(base))
        for i, (_, kind, _, _) in enumerate(specs):
            v = F.col(f"__v{i}")
            if kind in ("last", "next"):
                pick = F.max_by if kind == "last" else F.min_by
                aggs.append(pick(v, F.when(v.isNotNull(), F.col("__rn"))).alias(f"__c{i}"))
            else:
                aggs.append((F.sum(v) if kind == "sum" else F.max(v)).alias(f"__c{i}"))
        totals = src.groupBy(*part).agg(*aggs)
        before, after = [W.partitionBy(*(self.keys or [F.lit(1)])).orderBy(o).rowsBetween(W.unboundedPreceding, -1)
                         for o in (F.col("_slab"), F.col("_slab").desc())]
        last = lambda c: F.last(c, ignorenulls=True)
        seen = F.count(F.lit(1)).over(before)
        carry = totals.select(
            F.col("_slab").alias("__cs"),
            *[F.col(k).alias(f"__ck_{k}") for k in self.keys],
            (seen + F.count(F.lit(1)).over(after) if "next" in kinds else seen).alias("__seen"),
            *[{"sum": F.sum, "max": F.max, "last": last, "next": last}[kind](F.col(f"__c{i}"))
              .over(after if kind == "next" else before).alias(f"__p{i}") for i, (_, kind, _, _) in enumerate(specs)],
        ).where("__seen > 0")
        cond = df["_slab"] == carry["__cs"]
        for k in self.keys:
            cond = cond & df[k].eqNullSafe(carry[f"__ck_{k}"])
        df = df.join(F.broadcast(carry), cond, "left")
        for i, (out, kind, _, _) in enumerate(specs):
            p = F.col(f"__p{i}")
            if kind == "sum":
                df = df.withColumn(out, F.coalesce(F.col(out), F.lit(0)) + F.coalesce(p, F.lit(0)))
            elif kind == "max":
                df = df.withColumn(out, F.greatest(F.col(out), p))
            else:
                df = df.withColumn(out, F.coalesce(F.col(out), p))
        drop = ["__cs", "__seen"] + [f"__ck_{k}" for k in self.keys]
        drop += [f"__v{i}" for i in range(len(specs))] + [f"__p{i}" for i in range(len(specs))]
        self.df = df.drop(*drop)
        return self

    def where(self, cond) -> "Slabs":
        self.df = self.df.where(cond)
        return self

    def result(self) -> DataFrame:
        return self.df.drop("_slab")


def number_rows(df: DataFrame, order: list, name: str = "rn", keys: list[str] = ()) -> DataFrame:
    """1-based row number in ``order`` within ``keys`` (W6), hot keys included."""
    return Slabs(df, list(keys), order).scan((name, "sum", F.lit(1).cast("long"), True)).result()
