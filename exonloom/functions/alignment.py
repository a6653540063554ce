"""Difference-string (cs) expansion and span arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import computed_once

# Intron ends (first two, last two bases) seen as canonical per strand.
CANONICAL_PLUS = r"^(gt.*ag|at.*ac)$"
CANONICAL_MINUS = r"^(ct.*ac|gt.*at)$"


def is_canonical_splice(intron: Column, strand: Column) -> Column:
    return F.when(strand == "+", intron.rlike(CANONICAL_PLUS)).otherwise(intron.rlike(CANONICAL_MINUS))


def expand_cs(alignments: DataFrame) -> DataFrame:
    """exon blocks with query spans, identity and splice flag of every alignment.

    The string is cut at its introns; matches of a segment advance both sides and
    insertions the query. The splice flag is that of the last intron, true without one.
    """
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))
    intron = r"~([a-z]{2}\d+[a-z]{2})"
    segs = F.split("cs", "~[a-z]{2}[0-9]+[a-z]{2}", -1)
    base = alignments.withColumn("strand", F.when(F.col("flag") == 0, "+").otherwise("-"))
    cut = computed_once(base, "_c", F.struct(
        F.transform(segs, lambda g: F.struct(total(F.regexp_extract_all(g, F.lit(r":(\d+)"), F.lit(1))).alias("m"),
                                             F.length(F.array_join(F.regexp_extract_all(g, F.lit(r"\+([a-z]+)"), F.lit(1)), "")).cast("bigint").alias("i"))).alias("seg"),
        F.transform(F.regexp_extract_all("cs", F.lit(r"~[a-z]{2}(\d+)[a-z]{2}"), F.lit(1)), lambda x: x.cast("bigint")).alias("gap"),
        F.get(F.reverse(F.regexp_extract_all("cs", F.lit(intron), F.lit(1))), F.lit(0)).alias("last")))
    seg, gap, n = F.col("_c.seg"), F.col("_c.gap"), F.col("seq_len")
    zero = F.lit(0).cast("bigint")
    def block(x, i):
        before = F.slice(seg, 1, i)
        m0 = F.aggregate(before, zero, lambda acc, y: acc + y["m"])
        q0 = F.aggregate(before, zero, lambda acc, y: acc + y["m"] + y["i"])
        start = F.col("pos") + m0 + F.aggregate(F.slice(gap, 1, i), zero, lambda acc, y: acc + y)
        qa = q0 + 1
        qb = F.when(i == F.size(seg) - 1, n).otherwise(q0 + x["m"] + x["i"])
        plus = F.col("strand") == "+"
        return F.struct(start.alias("start"), (start + x["m"] - 1).alias("end"), F.when(plus, qa).otherwise(n - qb + 1).alias("qstart"),
                        F.when(plus, qb).otherwise(n - qa + 1).alias("qend"))
    matches = F.aggregate(seg, zero, lambda acc, y: acc + y["m"])
    gaps = (F.length("cs") - F.length(F.translate("cs", "+-", ""))).cast("bigint")
    wide = computed_once(cut, "_m", matches).withColumn("_g", gaps)
    return wide.select(*alignments.columns, "strand", F.transform(seg, block).alias("exons"), F.col("_m").alias("matches"), F.col("_g").alias("gaps"),
                       F.coalesce(is_canonical_splice(F.col("_c.last"), F.col("strand")), F.lit(True)).alias("proper_splice"),
                       (F.lit(100.0) * F.col("_m") / (F.col("_m") + F.col("nm") - F.col("_g"))).alias("pident"))


def filter_spliced(expanded: DataFrame, min_pident: float = 80.0, relabel_at: float = 95.0) -> DataFrame:
    """Canonical splice and identity; label ``cDNA_match`` above ``relabel_at``, else ``EST_match``."""
    good = expanded.where(F.col("proper_splice") & (F.col("pident") >= min_pident))
    return good.withColumn("feature", F.when(F.col("pident") > relabel_at, "cDNA_match").otherwise("EST_match"))


def span_overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """half-open overlap as a share of the first span."""
    shared = F.greatest(F.least(e1, e2) - F.greatest(s1, s2), F.lit(0))
    return F.when(e1 > s1, shared / (e1 - s1)).otherwise(F.lit(0.0))
