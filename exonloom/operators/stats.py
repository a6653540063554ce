"""Assembly and annotation statistics (A1-A7, A23, A31 and friends)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..scale import Slabs, attach_row


def assembly_stats(sequences: DataFrame) -> DataFrame:
    """A1: one row of counts, lengths and overall GC percent."""
    n = F.length("seq")
    return sequences.agg(
        F.count(F.lit(1)).alias("contigs"), F.sum(n).alias("total"), F.round(F.avg(n), 2).alias("mean"),
        F.max(n).cast("long").alias("longest"),
        F.round(F.sum(S.count_of(F.upper("seq"), "GCS")) * 100.0 / F.sum(n), 2).alias("gc"))


def _by_length(sequences: DataFrame) -> DataFrame:
    """Distinct lengths with counts: all that the N50 family needs."""
    return (sequences.select(F.length("seq").cast("long").alias("length")).where("length > 0")
            .groupBy("length").agg(F.count(F.lit(1)).alias("n")))


def nx(sequences: DataFrame, fractions=(0.5, 0.9)) -> DataFrame:
    """A2: N50/L50-style values; ``l`` is the rank of the first contig of that length."""
    lens = _by_length(sequences)
    total = lens.agg(F.sum(F.col("length") * F.col("n"))).scalar()
    scan = Slabs(lens, [], [F.col("length").desc()]).scan(
        ("_cum", "sum", F.col("length") * F.col("n"), True), ("_longer", "sum", F.col("n"), False)).result()
    scan = scan.withColumn("_total", total)
    cols = []
    for f in fractions:
        tag = int(round(f * 100))
        reached = F.when(F.col("_cum") >= F.col("_total") * f, F.struct("length", "_longer"))
        cols.append(F.max(reached).alias(f"_{tag}"))
    out = scan.agg(*cols)
    sel = []
    for f in fractions:
        tag = int(round(f * 100))
        sel += [F.col(f"_{tag}.length").alias(f"n{tag}"), (F.col(f"_{tag}._longer") + 1).alias(f"l{tag}")]
    return out.select(*sel)


def n50_weighted(sequences: DataFrame) -> DataFrame:
    """A3: length-weighted median; the integer mean of the two middle values for even totals."""
    lens = _by_length(sequences)
    total = lens.agg(F.sum(F.col("length") * F.col("n"))).scalar()
    scan = (Slabs(lens, [], ["length"]).scan(("_cum", "sum", F.col("length") * F.col("n"), True)).result()
            .withColumn("_t", total))
    at = lambda pos: F.min(F.when(F.col("_cum") > pos, F.col("length")))
    mid = F.floor(F.col("_t") / 2)
    out = scan.agg(at(mid).alias("hi"), at(mid - 1).alias("lo"), F.max("_t").alias("t"))
    return out.select(F.when(F.col("t") % 2 == 0, F.floor((F.col("hi") + F.col("lo")) / 2)).otherwise(F.col("hi")).alias("n50"))


def count_features(features: DataFrame, by: list[str]) -> DataFrame:
    """Counts per combination and in total (null keys)."""
    return features.rollup(*by).agg(F.count(F.lit(1)).alias("n"))


def genome_summary(sequences: DataFrame, genes: DataFrame) -> DataFrame:
    """One row of assembly statistics joined with gene counts by biotype."""
    g = genes.agg(F.count(F.lit(1)).alias("genes"), F.count_if(F.col("biotype") == "mRNA").alias("proteins"),
                  F.count_if(F.col("biotype") == "tRNA").alias("trnas"))
    return attach_row(attach_row(assembly_stats(sequences), n50_weighted(sequences)), g)


def reads_per_transcript(alignments: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Aligned reads per transcript, 0 for unseen ones."""
    n = alignments.groupBy("tx_id").agg(F.count(F.lit(1)).alias("n_reads"))
    return transcripts.join(n, "tx_id", "left").withColumn("n_reads", F.coalesce("n_reads", F.lit(0).cast("long")))


# Functional channels and the note or cross reference that marks each.
FUNCTIONAL_XREFS = {"pfam": "PFAM:", "interproscan": "InterPro:"}
FUNCTIONAL_NOTES = {"eggnog": "EggNog:", "cazyme": "CAZy:", "merops": "MEROPS:", "busco": "BUSCO:", "secretion": "SECRETED:"}


def functional_counts(models: DataFrame) -> DataFrame:
    """A4: coding transcripts with each kind of functional annotation, and the mean protein length.

    ``models(biotype, go, dbxrefs, notes, protein_length)`` with lists of texts.
    """
    own = models.where("biotype = 'mRNA'")
    marked = lambda c, p: F.count_if(F.coalesce(F.exists(c, lambda x: x.startswith(p)), F.lit(False)))
    return own.agg(F.count_if(F.coalesce(F.size("go") > 0, F.lit(False))).alias("go_terms"), *[marked("dbxrefs", p).alias(k) for k, p in FUNCTIONAL_XREFS.items()],
                   *[marked("notes", p).alias(k) for k, p in FUNCTIONAL_NOTES.items()], F.round(F.avg("protein_length"), 2).alias("avg_protein_length"))


def annotation_summary(models: DataFrame) -> DataFrame:
    """A4: one pass over transcripts ``(gene_id, biotype, name, length, protein_length,
    exons, five_utr, three_utr, partial_start, partial_stop)``.
    """
    mrna = F.col("biotype") == "mRNA"
    ps, pe = F.col("partial_start"), F.col("partial_stop")
    n_ex = F.col("n_exons")
    return models.agg(
        F.count_distinct("gene_id").alias("genes"),
        F.count_distinct(F.when(F.col("gene_name").isNotNull(), F.col("gene_id"))).alias("common_name"),
        F.count_if(mrna).alias("mrna"), F.count_if(F.col("biotype") == "tRNA").alias("trna"),
        F.count_if(F.col("biotype") == "ncRNA").alias("ncrna"), F.count_if(F.col("biotype") == "rRNA").alias("rrna"),
        F.round(F.avg(F.when(mrna, F.col("length"))), 2).alias("avg_length"),
        F.sum(F.when(mrna, n_ex)).alias("total_exons"),
        F.round(F.avg(F.when(mrna, n_ex)), 2).alias("avg_exons"),
        F.count_if(mrna & (n_ex == 1)).alias("single_exon"), F.count_if(mrna & (n_ex > 1)).alias("multiple_exon"),
        F.count_if(mrna & F.col("five_utr") & ~F.col("three_utr")).alias("five_utr_only"),
        F.count_if(mrna & ~F.col("five_utr") & F.col("three_utr")).alias("three_utr_only"),
        F.count_if(mrna & F.col("five_utr") & F.col("three_utr")).alias("both_utr"),
        F.count_if(mrna & ~F.col("five_utr") & ~F.col("three_utr")).alias("no_utr"),
        F.count_if(mrna & ~ps & ~pe).alias("complete"), F.count_if(mrna & ps & pe).alias("no_start_stop"),
        F.count_if(mrna & ps & ~pe).alias("no_start"), F.count_if(mrna & ~ps & pe).alias("no_stop"))


def busco_summary(status: DataFrame, lineage: DataFrame) -> DataFrame:
    """Complete / single / duplicated / fragmented / missing counts and percentages.

    ``status(busco, status)`` may repeat a complete BUSCO once per copy.
    """
    per = status.groupBy("busco").agg(F.count_if(F.col("status") == "Complete").alias("c"),
                                      F.count_if(F.col("status") == "Fragmented").alias("f"))
    one = lineage.select("busco").distinct().join(per, "busco", "left")
    c, f = F.coalesce("c", F.lit(0)), F.coalesce("f", F.lit(0))
    out = one.agg(F.count(F.lit(1)).alias("total"), F.count_if(c > 0).alias("complete"), F.count_if(c == 1).alias("single"),
                  F.count_if(c > 1).alias("duplicated"), F.count_if((c == 0) & (f > 0)).alias("fragmented"),
                  F.count_if((c == 0) & (f == 0)).alias("missing"))
    for k in ("complete", "single", "duplicated", "fragmented", "missing"):
        out = out.withColumn(f"{k}_pct", F.round(F.col(k) * 100.0 / F.col("total"), 1))
    return out


def count_multi_cds(models: DataFrame, keep: DataFrame) -> DataFrame:
    """Models with several CDS parts, overall and within the ids in ``keep``."""
    flagged = models.join(keep.select("tx_id").distinct().withColumn("_k", F.lit(True)), "tx_id", "left")
    multi = F.col("n_cds") > 1
    return flagged.agg(F.count_if(multi).alias("multi"), F.count_if(multi & F.coalesce("_k", F.lit(False))).alias("multi_kept"))
