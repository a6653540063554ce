"""FASTA in pieces: no row holds a whole contig, so a chromosome spreads over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.sequences import PIECE


def read_fasta_pieces(spark: SparkSession, path, size: int = PIECE) -> DataFrame:
    """``(seq_id, description, piece, offset, chunk)`` with ``size`` letters a piece, read line by line.

    Letters are counted inside every file split; one row per split carries the count and the
    open record of the splits before it, so a record may span any number of splits. A record
    without letters is one empty piece. A single line is one row while it is read, however long.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("mid"))
    head = F.when(F.col("value").startswith(">"), F.regexp_replace(F.substring("value", F.lit(2), F.length("value")), "\r$", ""))
    text = F.when(head.isNull(), F.regexp_replace("value", r"\s+", "")).otherwise("")
    rows = raw.select("file", "block", "mid", head.alias("head"), text.alias("t"))
    upto = W.partitionBy("file", "block").orderBy("mid")
    rows = rows.withColumn("pos", F.coalesce(F.sum(F.length("t").cast("long")).over(upto.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    opened = F.struct("head", "pos")
    rows = rows.withColumn("own", F.last(F.when(F.col("head").isNotNull(), opened), ignorenulls=True).over(upto.rowsBetween(W.unboundedPreceding, W.currentRow)))
    plain = raw.select("file", "block", "mid", head.alias("head"), F.length(text).cast("long").alias("n"))
    plain = plain.withColumn("pos", F.coalesce(F.sum("n").over(upto.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    splits = plain.groupBy("file", "block").agg(F.sum("n").alias("letters"), F.max_by(opened, F.when(F.col("head").isNotNull(), F.col("mid"))).alias("last"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("first", F.coalesce(F.sum("letters").over(before), F.lit(0)))
    at = F.when(F.col("last").isNotNull(), F.struct(F.col("last.head").alias("head"), (F.col("last.pos") + F.col("first")).alias("pos")))
    splits = splits.withColumn("carried", F.last(at, ignorenulls=True).over(before)).select("file", "block", "first", "carried")
    own = F.when(F.col("own").isNotNull(), F.struct(F.col("own.head").alias("head"), (F.col("own.pos") + F.col("first")).alias("pos"))).otherwise(F.col("carried"))
    lines = rows.join(splits, ["file", "block"]).withColumn("record", own).where("record is not null")
    lines = lines.select("file", F.col("record.head").alias("head"), F.col("record.pos").alias("at"), (F.col("pos") + F.col("first") - F.col("record.pos")).alias("from"), "t", "mid")
    lines = lines.where("t <> '' or `from` = 0")
    return cut(lines, ["file", "head", "at"], size, "mid").select(
        F.substring_index("head", " ", 1).alias("seq_id"),
        F.when(F.col("head").contains(" "), F.substring("head", F.length(F.substring_index("head", " ", 1)) + 2, F.length("head"))).otherwise("").alias("description"), "piece", "offset", "chunk")


def cut(texts: DataFrame, keys: list[str], size: int, tie: str = "from") -> DataFrame:
    """Texts ``(*keys, from, t)`` that follow each other, cut anew into pieces of ``size`` letters."""
    last = F.greatest(F.col("from"), F.col("from") + F.length("t") - 1)
    bits = texts.withColumn("piece", F.explode(F.sequence(F.floor(F.col("from") / size), F.floor(last / size))))
    lo = F.greatest(F.col("piece") * size - F.col("from"), F.lit(0))
    part = F.substring("t", (lo + 1).cast("int"), ((F.col("piece") + 1) * size - F.col("from") - lo).cast("int"))
    bits = bits.select(*keys, "piece", F.struct(F.col("from").alias("f"), F.col(tie).alias("m"), part.alias("p")).alias("bit"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("bit")), lambda b: b["p"]), "")
    return bits.groupBy(*keys, "piece").agg(joined.alias("chunk")).withColumn("offset", F.col("piece") * size)
