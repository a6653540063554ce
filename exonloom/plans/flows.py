"""The three multi-step uses of the operators: predict, annotate, compare.

Each is one lineage of DataFrames; nothing is collected and nothing is cached
unless the caller does so. With ``steps`` every named step is stored and a flow that
broke off resumes from them, or a step is replaced by a table of the user's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import annotations as A
from ..operators import comparative as C
from ..operators import models as M
from ..operators import sequences as Q
from ..scale import number_rows
from .steps import Steps


def predict(models: DataFrame, evidence: DataFrame, sequences: DataFrame, repeats: DataFrame, repeat_hits: DataFrame,
            trnas: DataFrame, prefix: str = "GENE_", weights: dict[str, int] | None = None, transl_table: int = 1,
            steps: Steps | None = None) -> dict[str, DataFrame]:
    """Consensus of predicted models, quality filter, tRNA check and final locus names.

    Steps: ``consensus`` (tx_id), ``checked`` (models with reason), ``trnas``, ``names`` (gene_id, locus).
    """
    step = steps or Steps(models.sparkSession)
    chain = F.array_join(F.transform("exons", lambda e: F.concat(e["start"], F.lit("-"), e["end"])), ",")
    spans = models.select(F.col("tx_id").alias("name"), "contig", "strand", F.col("gene_start").alias("start"), F.col("gene_end").alias("end"), "source", chain.alias("chain"))
    chosen = step("consensus", lambda: M.consensus_models(spans, evidence, weights).select(F.col("name").alias("tx_id")))
    kept = M.add_sequences(models.join(chosen, "tx_id", "left_semi"), sequences, transl_table)
    checked = step("checked", lambda: M.flag_bad_models(kept.withColumn("start", F.col("gene_start")).withColumn("end", F.col("gene_end")), repeats, repeat_hits))
    good = checked.where("reason is null").drop("reason", "start", "end")
    gaps = Q.gap_intervals(sequences.select("seq_id", "seq"), 1).withColumnRenamed("seq_id", "contig")
    rna = step("trnas", lambda: M.validate_trna(trnas, good.select("contig", F.col("gene_start").alias("start"), F.col("gene_end").alias("end")), gaps))
    loci = good.groupBy("gene_id").agg(F.min("contig").alias("contig"), F.min("gene_start").alias("start"))
    named = step("names", lambda: Q.rename_ids(loci, ["contig", "start", "gene_id"], prefix).select("gene_id", F.col("new_id").alias("locus")))
    step.finish()
    return {"models": good.join(named, "gene_id").withColumn("gene_id", F.col("locus")).drop("locus"), "trnas": rna, "rejected": checked.where("reason is not null")}


def annotate(sources: list[DataFrame], prefixes: list[str], custom: DataFrame | None = None, fixes: DataFrame | None = None,
             removes: DataFrame | None = None, steps: Steps | None = None) -> dict[str, DataFrame]:
    """Union of all annotation sources, user overrides, and the routed channels.

    Steps: ``annotations`` (keyed), ``channels``, ``headers``.
    """
    step = steps or Steps(sources[0].sparkSession)

    def keyed() -> DataFrame:
        out = A.key_annotations(A.valid_annotations(A.union_annotations(*sources), prefixes).select("id", "ref_db", "value"))
        if custom is not None:
            out = A.apply_custom(out, custom)
        if fixes is not None and removes is not None:
            out = A.apply_fixes(out, fixes, removes)
        return A.ec_with_gene(out)

    found = step("annotations", keyed)
    out = {"annotations": found, "channels": step("channels", lambda: A.route_notes(found)), "headers": step("headers", lambda: A.note_headers(found))}
    step.finish()
    return out


def compare(channels: DataFrame, orthologs: DataFrame, egg: DataFrame, busco: DataFrame) -> dict[str, DataFrame]:
    """Comparative tables from routed annotations ``(species, gene_id, channel, hit)``."""
    fam = lambda k: channels.where(F.col("channel") == k).select("species", F.col("hit").alias("family"))
    counts = {k: C.family_counts(fam(k)) for k in ("PFAM", "InterPro", "MEROPS", "CAZy", "COG")}
    return {
        **{f"{k}_counts": v for k, v in counts.items()}, "pfam_distance": C.braycurtis(counts["PFAM"]), "cog_percent": C.percent_of_species(counts["COG"]),
        "merops_classes": C.class_counts(counts["MEROPS"], C.MEROPS_CLASSES), "cazy_classes": C.class_counts(counts["CAZy"], C.CAZY_CLASSES),
        "ortholog_groups": C.ortholog_groups(orthologs, egg, busco), "ortholog_stats": C.ortholog_stats(orthologs), "single_copy": C.single_copy(orthologs)}


def number_loci(models: DataFrame) -> DataFrame:
    """Running locus numbers over the whole genome in (contig, start) order."""
    return number_rows(models, ["contig", "gene_start", "gene_id"], "locus_no")
