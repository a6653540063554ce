"""Comparison of two annotations: edit distance, change classes, summaries."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sequence as S
from ..scale import attach_row
from .intervals import best_overlap_join, overlap_anti, overlap_semi


def gene_aed(pairs: DataFrame, new_tx: DataFrame, old_tx: DataFrame, col: str = "exons", out: str = "aed") -> DataFrame:
    """Least distance of every new transcript to the old ones, averaged per new gene.

    ``pairs(new_gene, old_gene)``. Copies of one structure count by weight, and
    structures found unchanged on the other side skip the pairwise step.
    """
    new = new_tx.groupBy(F.col("gene_id").alias("new_gene"), F.col(col).alias("q")).agg(F.count(F.lit(1)).alias("w"))
    new = pairs.select("new_gene", "old_gene").distinct().join(new, "new_gene")
    old = old_tx.select(F.col("gene_id").alias("old_gene"), F.col(col).alias("r")).distinct()
    same = new.join(old.withColumnRenamed("r", "q"), ["old_gene", "q"], "left_semi").withColumn("d", F.lit(0.0))
    rest = new.join(old.withColumnRenamed("r", "q"), ["old_gene", "q"], "left_anti").join(old, "old_gene")
    least = rest.groupBy("new_gene", "old_gene", "q", "w").agg(F.min(S.aed(F.col("q"), F.col("r"))).alias("d"))
    both = same.select("new_gene", "old_gene", "w", "d").unionByName(least.select("new_gene", "old_gene", "w", "d"))
    return both.groupBy("new_gene", "old_gene").agg(F.round(F.sum(F.col("w") * F.col("d")) / F.sum("w"), 3).alias(out))


def lcs_length(a: str, b: str) -> int:
    """Bit-parallel longest common subsequence (the score of a match-only global alignment).

    What both texts begin and end with belongs to it and is taken off first.
    """
    head = len(os.path.commonprefix((a, b)))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix((a[::-1], b[::-1])))
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return head + tail + len(a) - row.bit_count()


@F.pandas_udf(T.LongType())
def _lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(x, y) for x, y in zip(a, b)], dtype="int64")


def lcs_identity(a: Column, b: Column) -> Column:
    """100 * LCS / longer length; null inputs give null."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer > 0, _lcs(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))) * 100.0 / longer)


def add_identity(df: DataFrame, a: str, b: str, out: str = "pident") -> DataFrame:
    """F23 on a table: equal pairs never reach Python."""
    same = df.where(F.col(a).eqNullSafe(F.col(b))).withColumn(out, F.lit(100.0))
    rest = df.where(~F.col(a).eqNullSafe(F.col(b))).withColumn(out, lcs_identity(F.col(a), F.col(b)))
    return same.unionByName(rest)


def diff_models(old: DataFrame, new: DataFrame, key: str = "overlap", keys=("contig",),
                name: str = "name") -> DataFrame:
    """``status`` removed / new / matched with old and new names and spans.

    By ``overlap`` the closest overlapping old model is the partner; by ``id`` the
    partner must overlap and carry the same name.
    """
    keys = list(keys)
    side = lambda df, p: df.select(*keys, F.col(name).alias(f"{p}_{name}"), F.col("start").alias(f"{p}_start"), F.col("end").alias(f"{p}_end"))
    cols = keys + ["status", f"old_{name}", "old_start", "old_end", f"new_{name}", "new_start", "new_end"]
    pick = lambda df: df.select([F.col(c) if c in df.columns else F.lit(None).cast("string" if c.endswith(name) else "long").alias(c) for c in cols])
    removed = side(overlap_anti(old, new, keys), "old").withColumn("status", F.lit("removed"))
    base = new.select(*keys, "start", "end", name)
    if key == "overlap":
        touched = overlap_semi(base, old, keys)
        best = best_overlap_join(touched, old, keys, name)
        matched = best.select(*keys, F.lit("matched").alias("status"), f"old_{name}", "old_start", "old_end",
                              F.col(name).alias(f"new_{name}"), F.col("start").alias("new_start"), F.col("end").alias("new_end"))
        added = side(overlap_anti(base, old, keys), "new").withColumn("status", F.lit("new"))
    else:
        partner = side(old, "old")
        j = base.join(partner, (F.col(name) == F.col(f"old_{name}")) & (base[keys[0]] == partner[keys[0]]), "left").drop(*[partner[k] for k in keys])
        ok = (F.col("old_start") <= F.col("end")) & (F.col("old_end") >= F.col("start"))
        ok = F.coalesce(ok, F.lit(False))
        shaped = j.select(*keys, F.when(ok, "matched").otherwise("new").alias("status"),
                          *[F.when(ok, F.col(c)).alias(c) for c in (f"old_{name}", "old_start", "old_end")],
                          F.col(name).alias(f"new_{name}"), F.col("start").alias("new_start"), F.col("end").alias("new_end"))
        return pick(removed).unionByName(pick(shaped))
    return pick(removed).unionByName(pick(added)).unionByName(pick(matched))


def classify_change(moved: Column, five: Column, three: Column, mrna_aed: Column, cds_aed: Column, pidents: Column) -> Column:
    """Struct (message, class); the first matching class wins."""
    cds = F.concat(F.lit("CDS update [translation pident: "), F.array_join(F.transform(pidents, lambda p: F.concat(F.round(p, 0).cast("int").cast("string"), F.lit("%"))), ", "), F.lit("]"))
    text = F.concat_ws(";", F.when(moved, "gene coordinates updated"), F.when(moved & five, "5prime UTR added"), F.when(moved & three, "3prime UTR added"),
                       F.when(mrna_aed > 0, "mRNA updated"), F.when(cds_aed > 0, cds))
    cls = (F.when(text == "", "no_change").when(moved & (five | three), "utr_added").when(mrna_aed > 0, "exon_changed").otherwise("other"))
    return F.struct(F.when(text == "", "no change").otherwise(text).alias("message"), cls.alias("class"))


def utr_flags(exons: Column, cds: Column, strand: Column) -> Column:
    """F16: struct (five, three): exons reach beyond the CDS span on that side."""
    lo, hi = F.array_min(F.transform(cds, lambda c: c["start"])), F.array_max(F.transform(cds, lambda c: c["end"]))
    left = F.array_min(F.transform(exons, lambda e: e["start"])) < lo
    right = F.array_max(F.transform(exons, lambda e: e["end"])) > hi
    plus = strand == "+"
    return F.struct(F.when(plus, left).otherwise(right).alias("five"), F.when(plus, right).otherwise(left).alias("three"))


def compare_summary(diff: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per side with loci, unique, identical and mean distances.

    ``diff`` carries ``status, mrna_aed, cds_aed``; ``old``/``new`` carry ``biotype, n_tx``.
    """
    d = diff.agg(F.count_if(F.col("status") == "removed").alias("ref_unique"), F.count_if(F.col("status") == "new").alias("query_unique"),
                 F.count_if((F.col("status") == "matched") & (F.col("mrna_aed") == 0) & (F.col("cds_aed") == 0)).alias("unchanged"),
                 F.count_if((F.col("status") == "matched") & (F.col("mrna_aed") > 0) & (F.col("cds_aed") == 0)).alias("same_cds"),
                 F.round(F.avg("mrna_aed"), 3).alias("avg_mrna_aed"), F.round(F.avg("cds_aed"), 3).alias("avg_cds_aed"))
    def side(df, tag, unique, is_ref):
        m, t = F.col("biotype") == "mRNA", F.col("biotype") == "tRNA"
        c = df.agg(F.count(F.lit(1)).alias("loci"), F.count_if(m).alias("mrna_loci"), F.coalesce(F.sum(F.when(m, F.col("n_tx"))), F.lit(0)).alias("mrna_tx"),
                   F.count_if(t).alias("trna_loci"), F.coalesce(F.sum(F.when(t, F.col("n_tx"))), F.lit(0)).alias("trna_tx"))
        return attach_row(c, d).select(F.lit(tag).alias("side"), "loci", "mrna_loci", "mrna_tx", "trna_loci", "trna_tx", F.col(unique).alias("unique"), "unchanged", "same_cds",
                                F.when(F.lit(is_ref), 0.0).otherwise(F.col("avg_mrna_aed")).alias("avg_mrna_aed"),
                                F.when(F.lit(is_ref), 0.0).otherwise(F.col("avg_cds_aed")).alias("avg_cds_aed"))
    return side(old, "reference", "ref_unique", True).unionByName(side(new, "query", "query_unique", False))


def update_summary(diff: DataFrame) -> DataFrame:
    """Counters over ``status``, ``class`` and mean distances."""
    c = lambda v: F.count_if(F.col("class") == v)
    return diff.agg(
        F.count_if(F.col("status") != "removed").alias("total_genes"), F.count_if(F.col("status") == "new").alias("new_genes"),
        c("no_change").alias("no_change"), c("utr_added").alias("utr_added"), c("exon_changed").alias("exon_changed"), c("other").alias("other_changes"),
        F.count_if(F.col("status") == "removed").alias("dropped"), F.round(F.avg("mrna_aed"), 3).alias("mean_mrna_aed"), F.round(F.avg("cds_aed"), 3).alias("mean_cds_aed"))


