"""Cross-genome tables: family counts, distances, ortholog groups and reports."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import Slabs, materialize
from ..sources.pieces import cut
from .sequences import PIECE


# Class letters of proteases and carbohydrate-active enzymes.
MEROPS_CLASSES = ["A", "C", "G", "M", "N", "P", "S", "T", "U", "I"]
CAZY_CLASSES = ["GH", "GT", "PL", "CE", "CBM", "AA"]


def family_counts(annotations: DataFrame) -> DataFrame:
    """Long counts per (species, family)."""
    return annotations.groupBy("species", "family").agg(F.count(F.lit(1)).alias("n"))


def dense_counts(counts: DataFrame) -> DataFrame:
    """A8 with zeros: every family for every species (the species list is one small array)."""
    names = counts.agg(F.array_sort(F.collect_set("species"))).scalar()
    grid = counts.select("family").distinct().withColumn("species", F.explode_outer(names))
    return grid.join(counts, ["species", "family"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def count_matrix(counts: DataFrame, species: list[str]) -> DataFrame:
    """A8 at the edge: one row per family, one column per species."""
    return counts.groupBy("family").pivot("species", species).agg(F.sum("n")).fillna(0)


def class_counts(counts: DataFrame, classes: list[str]) -> DataFrame:
    """Families to their class letters; classes without hits do not appear."""
    cls = F.regexp_extract("family", "^[A-Z]+", 0)
    return (counts.withColumn("class", cls).where(F.col("class").isin(*classes))
            .groupBy("species", "class").agg(F.sum("n").alias("n")).where("n > 0"))


def percent_of_species(counts: DataFrame) -> DataFrame:
    """A10: share of each family within its species, in percent."""
    total = counts.groupBy("species").agg(F.sum("n").alias("_t"))
    return counts.join(total, "species").withColumn("pct", F.col("n") * 100.0 / F.col("_t")).drop("_t")


def drop_empty(counts: DataFrame, by: str) -> DataFrame:
    """Drop species (or families) whose counts are all zero."""
    some = counts.groupBy(by).agg(F.sum("n").alias("_t")).where("_t > 0").select(by)
    return counts.join(some, by, "left_semi")


def variable_families(counts: DataFrame, min_std: float | None = None) -> DataFrame:
    """Sample standard deviation over all species, missing ones as zero.

    Sums and squares of the present counts are enough, so no grid is built. With
    ``min_std`` only families that vary as much stay.
    """
    n_species = counts.agg(F.count_distinct("species")).scalar()
    sums = counts.groupBy("family").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q"))
    sums = sums.withColumn("k", n_species)
    var = (F.col("q") - F.col("s") * F.col("s") / F.col("k")) / (F.col("k") - 1)
    out = sums.withColumn("stdev", F.sqrt(F.greatest(var, F.lit(0.0))))
    return (out if min_std is None else out.where(F.col("stdev") >= min_std)).select("family", "stdev")


def _least_sums(i: int, within: bool, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of the lesser counts of all pairs between (or within) two blocks of species, family by family."""
    code, names = pd.factorize(rows["species"], sort=True)
    left, right = np.unique(code[rows["block"] == i]), np.unique(code[rows["block"] != i])
    right = left if within else right
    at = np.full(len(names), -1)
    at[left] = np.arange(len(left))
    if not within:
        at[right] = np.arange(len(right))
    rows = rows.assign(at=at[code]).sort_values("family", kind="stable")
    cuts = np.flatnonzero(rows["family"].to_numpy()[1:] != rows["family"].to_numpy()[:-1]) + 1
    n, place, one = rows["n"].to_numpy(), rows["at"].to_numpy(), (rows["block"] == i).to_numpy()
    sums = np.zeros((len(left), len(right)), np.int64)
    for s in np.split(np.arange(len(rows)), cuts):
        a = s[one[s]]
        b = a if within else s[~one[s]]
        if len(a) and len(b):
            sums[np.ix_(place[a], place[b])] += np.minimum.outer(n[a], n[b])
    x, y = np.nonzero(np.triu(sums, 1) if within else sums)
    first, second = names[left[x]].to_numpy(dtype=object), names[right[y]].to_numpy(dtype=object)
    swap = first > second
    return pd.DataFrame({"sp_a": np.where(swap, second, first), "sp_b": np.where(swap, first, second), "m": sums[x, y]})


def braycurtis(counts: DataFrame, block: int = 256, most: int = 1 << 20) -> DataFrame:
    """sum|a-b| / sum(a+b) = 1 - 2 * sum(min) / (A + B), one row per pair of species (``sp_a < sp_b``).

    A min-sum product: species are dealt into blocks of about ``block`` and families into parts, so that a
    task holds about ``most`` counts of two blocks and their square of sums. No family emits its pairs, and one
    shared by all species is spread over the pairs of blocks. The long output has half the square of the species.
    """
    counts = materialize(counts.select("species", "family", "n"), "counts")
    total = counts.groupBy("species").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("cells"))
    size = total.agg(F.sum("cells").alias("cells"), F.count(F.lit(1)).alias("k")).first()
    blocks = max(1, -(-size["k"] // block))
    parts = max(1, -(-2 * (size["cells"] or 0) // (blocks * most)))
    mine = F.pmod(F.xxhash64("species"), F.lit(blocks)).cast("int")

    def met(df):
        other = df.withColumn("block", mine).withColumn("o", F.explode(F.expr(f"sequence(0, {blocks - 1})")))
        return other.withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")}).drop("o")

    rows = met(counts.where("species is not null and family is not null").withColumn("part", F.pmod(F.xxhash64("family"), F.lit(parts))))
    sums = rows.groupBy("i", "j", "part").applyInPandas(lambda key, pdf: _least_sums(key[0], key[0] == key[1], pdf), "sp_a string, sp_b string, m long")
    shared = sums.groupBy("sp_a", "sp_b").agg(F.sum("m").alias("m"))
    ends = met(total)
    a = ends.where("block = i").select("i", "j", F.col("species").alias("s"), F.col("t").alias("ta"))
    b = ends.where("block = j").select("i", "j", F.col("species").alias("r"), F.col("t").alias("tb"))
    pairs = a.join(b, ["i", "j"]).where("i < j or s < r").select(F.least("s", "r").alias("sp_a"), F.greatest("s", "r").alias("sp_b"), (F.col("ta") + F.col("tb")).alias("both"))
    full = pairs.join(shared, ["sp_a", "sp_b"], "left")
    return full.select("sp_a", "sp_b", (1 - F.coalesce("m", F.lit(0)) * 2.0 / F.col("both")).alias("distance"))


def backbone_counts(products: DataFrame, clusters: DataFrame) -> DataFrame:
    """NRPS, PKS and hybrid backbones per species; ``other`` is what the clusters leave."""
    hyb = F.col("product").contains("Hybrid")
    nrps = F.col("product").contains("Nonribosomal Peptide Synthase (NRPS)")
    pks = F.col("product").contains("Polyketide synthase (PKS)")
    k = products.groupBy("species").agg(F.count_if(nrps).alias("nrps"), F.count_if(pks).alias("pks"), F.count_if(hyb).alias("hybrid"))
    c = clusters.groupBy("species").agg(F.count_distinct("cluster").alias("n_clusters"))
    zero = lambda x: F.coalesce(x, F.lit(0).cast("long"))
    j = c.join(k, "species", "full").select("species", *[zero(x).alias(x) for x in ("nrps", "pks", "hybrid", "n_clusters")])
    return j.withColumn("other", F.col("n_clusters") - F.col("nrps") - F.col("pks") - F.col("hybrid"))


def factor_counts(counts: DataFrame, factors: DataFrame) -> DataFrame:
    """Every listed factor for every species, zero where absent."""
    names = counts.agg(F.array_sort(F.collect_set("species"))).scalar()
    grid = factors.select("family", "description").withColumn("species", F.explode_outer(names))
    return grid.join(counts, ["species", "family"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def group_sizes(orth: DataFrame) -> DataFrame:
    return orth.groupBy("group_id").agg(F.count_distinct("species").alias("n_species"), F.count(F.lit(1)).alias("n_genes"))


def ortholog_groups(orth: DataFrame, egg: DataFrame, busco: DataFrame) -> DataFrame:
    """Groups of more than one species with distinct eggNOG and BUSCO names and members."""
    big = group_sizes(orth).where("n_species > 1").select("group_id")
    j = (orth.join(big, "group_id", "left_semi").join(egg.select("gene_id", "egg"), "gene_id", "left")
         .join(busco.select("gene_id", "busco"), "gene_id", "left"))
    text = lambda c: F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set(c)), ", "), F.lit("")), F.lit("None"))
    return j.groupBy("group_id").agg(text("egg").alias("eggs"), text("busco").alias("buscos"), text("gene_id").alias("members"))


def single_copy(orth: DataFrame) -> DataFrame:
    """Groups with exactly one gene in every species."""
    total = orth.agg(F.count_distinct("species")).scalar()
    g = group_sizes(orth).withColumn("_t", total)
    return g.where((F.col("n_species") == F.col("_t")) & (F.col("n_genes") == F.col("_t"))).select("group_id")


def busco_consistent_groups(orth: DataFrame, busco: DataFrame, outgroup: DataFrame | None = None) -> DataFrame:
    """Groups whose members share exactly one BUSCO (which the outgroup has)."""
    j = orth.join(busco.select("gene_id", "busco"), "gene_id")
    one = j.groupBy("group_id").agg(F.count_distinct("busco").alias("k"), F.min("busco").alias("busco")).where("k = 1").drop("k")
    return one if outgroup is None else one.join(outgroup.select("busco").distinct(), "busco", "left_semi").select("group_id", "busco")


def ortholog_stats(orth: DataFrame) -> DataFrame:
    """Per species genes, singletons (group of one species) and genes with orthologs."""
    g = group_sizes(orth)
    j = orth.join(g, "group_id")
    return j.groupBy("species").agg(F.count(F.lit(1)).alias("genes"), F.count_if(F.col("n_species") == 1).alias("singletons"),
                                    F.count_if(F.col("n_species") > 1).alias("with_orthologs"))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """Deterministic sample: the ``n`` smallest seeded hashes."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), key).limit(n)


def supermatrix(groups: DataFrame, proteins: DataFrame) -> DataFrame:
    """Proteins of single-copy groups joined per species in group order.

    The list per species holds one entry per selected group (a bounded panel).
    """
    j = groups.join(proteins, ["species", "gene_id"])
    lists = j.groupBy("species").agg(F.sort_array(F.collect_list(F.struct("group_id", "seq"))).alias("l"))
    return lists.select("species", F.size("l").alias("n_groups"), F.array_join(F.transform("l", lambda x: x["seq"]), "").alias("seq"))


def supermatrix_pieces(groups: DataFrame, proteins: DataFrame, size: int = PIECE) -> DataFrame:
    """A33 in pieces ``(seq_id, piece, offset, chunk)``, so that no species is one row, however many groups it has.

    ``groups(species, group_id, gene_id)`` with a gene for each species and group. A protein's place is the running length
    of those before it; ``sinks.text.write_fasta_blocks`` takes the table as it is.
    """
    j = groups.join(proteins, ["species", "gene_id"]).select("species", "group_id", "gene_id", F.col("seq").alias("t"))
    placed = Slabs(j, ["species"], ["group_id", "gene_id"]).scan(("from", "sum", F.length("t").cast("long"), False)).result()
    return cut(placed.withColumnRenamed("species", "seq_id"), ["seq_id"], size).select("seq_id", "piece", "offset", "chunk")


def duplicate_tags(genomes: DataFrame) -> DataFrame:
    """Locus-tag prefixes used by more than one genome."""
    return (genomes.groupBy("tag").agg(F.count_distinct("genome").alias("n_genomes")).where("n_genomes > 1"))


def next_locus(genes: DataFrame, tag: str = "gene_id") -> DataFrame:
    """Prefix, next number and zero-pad width of the last locus tag per prefix."""
    prefix = F.concat(F.substring_index(tag, "_", 1), F.lit("_"))
    digits = F.substring_index(tag, "_", -1)
    g = genes.select(prefix.alias("prefix"), digits.alias("d")).where(F.col("d").rlike(r"^\d+$"))
    return g.groupBy("prefix").agg(F.max_by("d", F.col("d").cast("long")).alias("d")).select(
        "prefix", (F.col("d").cast("long") + 1).alias("next_number"), F.length("d").alias("width"))


def poff_to_long(df: DataFrame, species: list[str]) -> DataFrame:
    """Wide ortholog table to ``(group_id, species, gene_id)``; ``*`` means absent."""
    pairs = F.explode_outer(F.array(*[F.struct(F.lit(s.replace(".faa", "")).alias("species"), F.col(f"`{s}`").alias("ids")) for s in species]))
    return (df.select("group_id", pairs.alias("p")).where(F.col("p.ids") != "*")
            .select("group_id", "p.species", F.explode_outer(F.split("p.ids", ",")).alias("gene_id")))


def gene_report(genes: DataFrame, channels: DataFrame, orth: DataFrame, kinds: list[str]) -> DataFrame:
    """One row per gene with a ``;``-joined column per annotation channel and its ortholog group."""
    hits = channels.where(F.col("channel").isin(*kinds))
    wide = hits.groupBy("gene_id").agg(*[
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("channel") == k, F.col("hit")))), ";").alias(k) for k in kinds])
    out = genes.join(wide, "gene_id", "left").join(orth.select("gene_id", "group_id"), "gene_id", "left")
    return out.fillna("", kinds + ["group_id"])


# Columns of the per-gene comparison report.
REPORT_COLUMNS = ["GeneID", "scaffold:start-end", "strand", "length", "description", "Ortho Group", "EggNog", "BUSCO", "Secreted", "TransMembrane", "Protease family", "CAZyme family",
                  "Transcription factor", "InterPro Domains", "PFAM Domains", "GO terms", "SecMet Cluster", "SMCOG"]
REPORT_LISTS = {"Protease family": "MEROPS", "CAZyme family": "CAZy", "InterPro Domains": "InterPro", "PFAM Domains": "PFAM", "GO terms": "GO"}
REPORT_FIRST = {"BUSCO": "BUSCO", "Secreted": "Secreted", "TransMembrane": "TransMembrane"}


def full_gene_report(genes: DataFrame, hits: DataFrame, orth: DataFrame, factors: DataFrame) -> DataFrame:
    """One row per gene with the fixed columns.

    ``genes(gene_id, contig, start, end, strand, protein_length, product, notes)``, ``hits(gene_id,
    channel, ord, hit)``, ``orth(gene_id, group_id)``, ``factors(term, description)``. Lists hold what one
    gene carries, in order; the last domain known as a factor names the factor. Starts are 0-based.
    """
    f = hits.join(factors.select(F.col("term").alias("_term"), F.col("description").alias("_factor")),
                  (F.col("channel") == "InterPro") & (F.substring_index("hit", ":", 1) == F.col("_term")), "left")
    of = lambda k: F.when(F.col("channel") == k, F.struct("ord", "hit"))
    wide = f.groupBy("gene_id").agg(
        *[F.array_join(F.transform(F.array_sort(F.collect_list(of(k))), lambda x: x["hit"]), "; ").alias(c) for c, k in REPORT_LISTS.items()],
        *[F.min(of(k))["hit"].alias(c) for c, k in REPORT_FIRST.items()],
        F.max(F.when(F.col("_factor").isNotNull(), F.struct("ord", "_factor")))["_factor"].alias("Transcription factor"))
    g = genes.withColumns({"_egg": F.try_element_at(F.filter("notes", lambda x: x.startswith("EggNog:")), F.lit(-1)),
                           "_sm": F.try_element_at(F.filter("notes", lambda x: x.startswith("antiSMASH:")), F.lit(-1)),
                           "SMCOG": F.try_element_at(F.filter("notes", lambda x: x.startswith("SMCOG:")), F.lit(-1))})
    out = g.join(wide, "gene_id", "left").join(orth.select("gene_id", F.col("group_id").alias("Ortho Group")), "gene_id", "left")
    cells = {"GeneID": F.col("gene_id"), "scaffold:start-end": F.concat("contig", F.lit(":"), F.col("start") - 1, F.lit("-"), "end"), "length": F.col("protein_length").cast("string"),
             "description": F.col("product"), "EggNog": F.replace("_egg", F.lit("EggNog:"), F.lit("")), "SecMet Cluster": F.replace("_sm", F.lit("antiSMASH:"), F.lit(""))}
    return out.select(*[F.coalesce(cells.get(c, F.col(f"`{c}`")), F.lit("")).alias(c) for c in REPORT_COLUMNS])


def any_annotation(counts: DataFrame) -> Column:
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)) > 0).scalar()
