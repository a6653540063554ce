"""Gene-finder outputs brought to the common feature and model shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import Slabs, number_rows


def renumber_predictions(features: DataFrame, anchor: str, gene_base: str, tx_base: str, source: str) -> DataFrame:
    """Anchor rows become numbered genes with one transcript; CDS rows give exon and CDS rows.

    Numbers follow (contig, start, id); exon numbers follow the part starts.
    """
    clean = features.withColumn("id", F.substring_index("id", " ", 1)).withColumn("parent", F.substring_index(F.get("parents", F.lit(0)), " ", 1))
    heads = clean.where(F.col("feature") == anchor).select(F.col("id").alias("old_id"), "contig", "start", "end", "strand", "score")
    num = number_rows(heads, ["contig", "start", "old_id"], "_n")
    gid = F.concat(F.lit(gene_base), "_n")
    tid = F.concat(F.lit(tx_base), "_n", F.lit("-T1"))
    top = num.select("old_id", gid.alias("gene_id"), tid.alias("tx_id"), "contig", "start", "end", "strand")
    null = F.lit(None).cast("string")
    gene = top.select("contig", F.lit("gene").alias("feature"), "start", "end", "strand", F.lit(None).cast("int").alias("phase"), F.col("gene_id").alias("id"), null.alias("parent"), F.col("old_id").alias("alias"))
    mrna = top.select("contig", F.lit("mRNA").alias("feature"), "start", "end", "strand", F.lit(None).cast("int").alias("phase"), F.col("tx_id").alias("id"), F.col("gene_id").alias("parent"), F.col("old_id").alias("alias"))
    cds = clean.where("feature = 'CDS'").select(F.col("parent").alias("old_id"), "start", "end", "phase").join(top.select("old_id", "tx_id", "contig", "strand"), "old_id")
    ranked = Slabs(cds, ["tx_id"], ["start", "end"]).scan(("_i", "sum", F.lit(1).cast("long"), True)).result()
    both = F.explode_outer(F.array(
        F.struct(F.lit("exon").alias("feature"), F.lit(None).cast("int").alias("phase"), F.concat("tx_id", F.lit(".exon"), "_i").alias("id")),
        F.struct(F.lit("CDS").alias("feature"), F.col("phase").cast("int").alias("phase"), F.concat("tx_id", F.lit(".cds")).alias("id"))))
    kids = ranked.select("contig", "start", "end", "strand", "tx_id", both.alias("x")).select(
        "contig", "x.feature", "start", "end", "strand", "x.phase", "x.id", F.col("tx_id").alias("parent"), null.alias("alias"))
    return gene.unionByName(mrna).unionByName(kids).withColumn("source", F.lit(source))


def glimmer_features(features: DataFrame) -> DataFrame:
    """S28."""
    return renumber_predictions(features, "mRNA", "glimmerG_", "glimmerT_", "GlimmerHMM")


def codingquarry_features(features: DataFrame) -> DataFrame:
    """S29."""
    return renumber_predictions(features, "gene", "gene_", "transcript_", "CodingQuarry")


def zff_models(parts: DataFrame) -> DataFrame:
    """One model per name; the phase stays unknown, so translation picks the frame."""
    span = F.struct("start", "end")
    g = parts.groupBy("contig", F.col("tx_id").alias("gene_id"), "strand").agg(
        F.sort_array(F.collect_list(span)).alias("exons"), F.min("start").alias("gene_start"), F.max("end").alias("gene_end"))
    return g.select("gene_id", F.concat("gene_id", F.lit("-T1")).alias("tx_id"), "contig", F.lit("snap").alias("source"), "strand", F.lit("mRNA").alias("type"), F.lit(None).cast("string").alias("name"),
                    F.lit("hypothetical protein").alias("product"), "gene_start", "gene_end", "exons", F.col("exons").alias("cds"), F.lit(None).cast("int").alias("codon_start"))
