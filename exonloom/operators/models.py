"""Gene models: assembly from feature rows, validation, selection and consensus.

``models`` holds one row per transcript: ``gene_id, tx_id, contig, source, strand,
type, name, product, gene_start, gene_end, exons, cds`` (ascending spans),
``codon_start, pseudo`` and the list columns ``synonyms, notes, dbxrefs, go, ec``.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..scale import Slabs, attach_row, computed_once, materialize, number_rows
from ..sources.lines import MODEL_FEATURES
from .intervals import covered_spans, flag_overlap, overlap_anti, overlap_fraction, overlap_semi
from .schedule import schedule
from .sequences import splice_lists

RNA_KINDS = ["mRNA", "transcript", "tRNA", "ncRNA", "rRNA"]
# Evidence weights when none are given.
DEFAULT_WEIGHTS = {"augustus": 1, "hiq": 2, "genemark": 1, "pasa": 6, "codingquarry": 0, "snap": 1, "glimmerhmm": 1}


def gene_models(features: DataFrame, sequences: DataFrame | None = None) -> DataFrame:
    """Link genes, transcripts and their parts; drop genes with an mRNA lacking CDS.

    Parts hang on a transcript by its id, so every group is one transcript.
    """
    f = features.where(F.col("feature").isin(*MODEL_FEATURES))
    if sequences is not None:
        f = f.join(sequences.select(F.col("seq_id").alias("contig")).distinct(), "contig", "left_semi")
    is_gene, is_tx = F.col("feature").isin("gene", "pseudogene"), F.col("feature").isin(*RNA_KINDS)
    is_part = F.col("feature").isin("exon", "CDS") & F.col("parents").isNotNull()
    # genes and transcripts stand under their id and parts under that of their transcript, so one grouping reads
    # the features once; transcripts without an id are kept apart, as they have no parts
    tx = F.struct(F.get("parents", F.lit(0)).alias("gene_id"), "contig", "source", "strand", F.when(F.col("gbkey") == "misc_RNA", "ncRNA").otherwise(F.col("feature")).alias("type"),
                  "product", "notes", "dbxrefs", "go", "ec", F.col("start").alias("t0"), F.col("end").alias("t1"))
    rows = f.where(is_gene | is_tx | is_part).select(
        F.explode_outer(F.when(is_part, F.col("parents")).otherwise(F.array("id"))).alias("key"), F.when(is_tx & F.col("id").isNull(), F.xxhash64("contig", "start", "end", "parents")).alias("_apart"),
        "feature", "start", "end", "phase", F.when(is_tx, tx).alias("_tx"), F.when(is_gene, F.col("name")).alias("name"), F.when(is_gene, F.col("synonyms")).alias("synonyms"))
    span = F.struct("start", "end")
    is_gene = F.col("feature").isin("gene", "pseudogene")
    by_id = rows.where(F.col("key").isNotNull() | F.col("_tx").isNotNull()).groupBy("key", "_apart").agg(
        F.sort_array(F.collect_list(F.when(F.col("feature") == "exon", span))).alias("exons"),
        F.sort_array(F.collect_list(F.when(F.col("feature") == "CDS", span))).alias("cds"),
        F.min_by("phase", F.when(F.col("feature") == "CDS", F.col("start"))).alias("phase_left"),
        F.max_by("phase", F.when(F.col("feature") == "CDS", F.col("end"))).alias("phase_right"),
        F.bool_or((F.col("feature") == "CDS") & F.col("phase").isNull()).alias("phase_unknown"),
        F.collect_list("_tx").alias("tx"), F.bool_or(is_gene).alias("is_gene"), F.max("name").alias("name"), F.bool_or(F.col("feature") == "pseudogene").alias("pseudo"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("synonyms")))).alias("synonyms"))
    by_id = materialize(by_id.drop("_apart"), "by_id")
    genes = by_id.where("is_gene").select(F.col("key").alias("gene_id"), "name", "pseudo", "synonyms")
    m = by_id.select(F.col("key").alias("tx_id"), "exons", "cds", "phase_left", "phase_right", "phase_unknown", F.explode("tx").alias("_t")).select("_t.*", "tx_id", "exons", "cds", "phase_left", "phase_right", "phase_unknown")
    lo = F.array_min(F.transform("exons", lambda e: e["start"]))
    hi = F.array_max(F.transform("exons", lambda e: e["end"]))
    bad = (F.col("type") == "mRNA") & (F.size("cds") == 0)
    ends = m.groupBy("gene_id").agg(F.min(F.coalesce(lo, "t0")).alias("gene_start"), F.max(F.coalesce(hi, "t1")).alias("gene_end"), F.bool_or(bad).alias("_bad"))
    m = m.join(ends.where("not _bad"), "gene_id").join(genes, "gene_id", "left")
    phase = F.when(F.col("strand") == "+", F.col("phase_left")).otherwise(F.col("phase_right"))
    return m.select(
        "gene_id", "tx_id", "contig", "source", "strand", "type", "name",
        F.coalesce("product", F.when(F.col("type").isin("mRNA", "transcript"), "hypothetical protein")).alias("product"), "gene_start", "gene_end", "exons", "cds",
        F.when(~F.coalesce("phase_unknown", F.lit(False)), phase + 1).alias("codon_start"), F.coalesce("pseudo", F.lit(False)).alias("pseudo"),
        F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms"), "notes", "dbxrefs", "go", "ec")


def gtf_models(features: DataFrame) -> DataFrame:
    """Transcripts from GTF rows; exons double as coding parts."""
    ex = features.where("feature = 'exon'").groupBy("tx_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("exons"))
    tx = features.where("feature = 'transcript'").select("gene_id", "tx_id", "contig", "source", "strand", "tpm", "start", "end")
    g = tx.groupBy("gene_id").agg(F.min("start").alias("gene_start"), F.max("end").alias("gene_end"))
    return tx.drop("start", "end").join(ex, "tx_id").join(g, "gene_id").withColumn("cds", F.col("exons")).withColumn("codon_start", F.lit(1)).withColumn("type", F.lit("mRNA"))


def add_sequences(models: DataFrame, sequences: DataFrame, transl_table: int = 1) -> DataFrame:
    """Transcript, coding sequence and protein; unknown phases take the frame with fewest stops."""
    t = splice_lists(models, sequences, {"exons": "transcript", "cds": "_c"})
    # only what has no phase is translated in three frames
    frame = S.best_frame(F.when(F.col("codon_start").isNull(), F.col("_c")), F.col("strand"), transl_table)["frame"]
    t = t.withColumn("codon_start", F.coalesce("codon_start", frame))
    oriented = F.when(F.col("strand") == "-", S.revcomp(F.col("_c"))).otherwise(F.upper("_c"))
    t = t.withColumn("cds_seq", F.substring(oriented, F.col("codon_start"), F.length("_c"))).drop("_c")
    t = t.withColumn("protein", F.when(F.col("type") == "mRNA", S.translate(F.col("cds_seq"), 0, transl_table)))
    return t.withColumn("partial_start", S.partial_start(F.col("protein"), F.col("codon_start"))).withColumn("partial_stop", S.partial_stop(F.col("protein")))


def valid_models(models: DataFrame) -> DataFrame:
    """Typed, not pseudo, and coding transcripts with exons and CDS."""
    ok = F.col("type").isNotNull() & ~F.col("pseudo")
    return models.where(ok & ((F.col("type") != "mRNA") | ((F.size("cds") > 0) & (F.size("exons") > 0))))


def validate_proteins(tx: DataFrame, min_len: int = 50) -> DataFrame:
    """Reason ``too_short`` or ``internal_stop`` and the partial flags."""
    body = F.expr("substring(protein, 1, greatest(length(protein) - 1, 0))")
    reason = F.when(F.length("protein") - 1 < min_len, "too_short").when(F.instr(body, "*") > 0, "internal_stop")
    return (tx.withColumn("reason", reason).withColumn("partial_start", S.partial_start(F.col("protein"), F.col("codon_start")))
            .withColumn("partial_stop", S.partial_stop(F.col("protein"))))


def flag_bad_models(models: DataFrame, repeats: DataFrame, hits: DataFrame, min_len: int = 50, methods=("overlap", "blast")) -> DataFrame:
    """Reason per model ``(gene_id, contig, start, end, protein)``; null means keep.

    A protein that runs into a gap wins, then both repeat kinds, one of them, too short.
    """
    out = models.withColumn("_o", F.lit(False)).withColumn("_b", F.lit(False))
    if "overlap" in methods:
        o = overlap_fraction(models.select("gene_id", "contig", "start", "end"), repeats, 0.9).select("gene_id").distinct().withColumn("_f", F.lit(True))
        out = out.join(o, "gene_id", "left").withColumn("_o", F.coalesce("_f", F.lit(False))).drop("_f")
    if "blast" in methods:
        b = hits.select("gene_id").distinct().withColumn("_f", F.lit(True))
        out = out.join(b, "gene_id", "left").withColumn("_b", F.coalesce("_f", F.lit(False))).drop("_f")
    body = F.expr("substring(protein, 1, greatest(length(protein) - 1, 0))")
    reason = (F.when(body.contains("XX"), "model_span_gap").when(F.col("_o") & F.col("_b"), "repeat_overlap|repeat_match").when(F.col("_o"), "repeat_overlap")
              .when(F.col("_b"), "repeat_match").when(F.length(body) < min_len, "seq_too_short"))
    return out.withColumn("reason", reason).drop("_o", "_b")


def flag_high_quality(features: DataFrame, support: DataFrame, key: str = "gene_id", cut: float = 89.0) -> DataFrame:
    """P20: source ``HiQ`` above the hint support cut."""
    s = support.groupBy(key).agg(F.max("support").alias("_s"))
    return features.join(s, key, "left").withColumn("source", F.when(F.col("_s") > cut, "HiQ").otherwise(F.col("source"))).drop("_s")


def split_biotypes(models: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Coding and non-coding models."""
    return models.where("type = 'mRNA'"), models.where(F.col("type").isin("tRNA", "rRNA", "ncRNA"))


def mark_pseudo_trna(features: DataFrame) -> DataFrame:
    """P24."""
    return features.withColumn("pseudo", F.coalesce(F.col("product") == "tRNA-Xxx", F.lit(False)))


def order_transcripts(tx: DataFrame, by: str = "tpm") -> DataFrame:
    """``gene-T1..n`` by falling expression; genes without any keep their order."""
    ranked = number_rows(tx, [F.col(by).desc_nulls_last(), "tx_ord", "tx_id"], "rank", ["gene_id"])
    return ranked.withColumn("rank", F.col("rank").cast("int")).withColumn("new_tx_id", F.concat("gene_id", F.lit("-T"), "rank"))


def cds_phase(cds: Column, strand: Column, codon_start: Column) -> Column:
    """CDS parts in reading order with their phase."""
    ordered = F.when(strand == "-", F.reverse(F.array_sort(cds))).otherwise(F.array_sort(cds))
    # coding length before each part, and after the last
    before = F.aggregate(ordered, F.array(F.lit(0).cast("bigint")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["end"] - x["start"] + 1)))
    return F.zip_with(ordered, F.slice(before, 1, F.size(ordered)), lambda c, b: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), F.pmod(codon_start - 1 - b, F.lit(3)).cast("int").alias("phase")))


def exon_hints(alignments: DataFrame, priority: int = 4, src: str = "E") -> DataFrame:
    """First and last exon ``ep``, inner ones ``exon``, gaps ``intron`` (score 1)."""
    n = F.size("exons")
    ex = F.transform("exons", lambda e, i: F.struct(F.when((i == 0) | (i == n - 1), "ep").otherwise("exon").alias("feature"), e["start"].alias("start"), e["end"].alias("end"), F.lit(0).alias("score")))
    gap = F.zip_with(F.slice("exons", 1, n - 1), F.slice("exons", 2, n - 1),
                     lambda l, r: F.struct(F.lit("intron").alias("feature"), (l["end"] + 1).alias("start"), (r["start"] - 1).alias("end"), F.lit(1).alias("score")))
    both = F.concat(ex, F.when(n > 1, gap).otherwise(F.array().cast("array<struct<feature:string,start:bigint,end:bigint,score:int>>")))
    rows = alignments.select("contig", "strand", F.col("tx_id").alias("grp"), F.explode_outer(both).alias("h")).where("h is not null")
    return rows.select("contig", "h.feature", "h.start", "h.end", "h.score", "strand", "grp", F.lit(priority).alias("pri"), F.lit(src).alias("src"))


def protein_hints(alignments: DataFrame, trim: int = 15, priority: int = 4) -> DataFrame:
    """Coding parts shrunk by ``trim`` on both sides, and introns."""
    n = F.size("exons")
    part = F.transform("exons", lambda e: F.struct(F.lit("CDSpart").alias("feature"), (e["start"] + trim).alias("start"), (e["end"] - trim).alias("end")))
    gap = F.zip_with(F.slice("exons", 1, n - 1), F.slice("exons", 2, n - 1), lambda l, r: F.struct(F.lit("intron").alias("feature"), (l["end"] + 1).alias("start"), (r["start"] - 1).alias("end")))
    both = F.concat(part, F.when(n > 1, gap).otherwise(F.array().cast("array<struct<feature:string,start:bigint,end:bigint>>")))
    rows = alignments.select("contig", "strand", F.col("target").alias("grp"), F.explode_outer(both).alias("h")).where("h is not null")
    return rows.select("contig", "h.feature", "h.start", "h.end", "strand", "grp", F.lit(priority).alias("pri"), F.lit("XNT").alias("src"))


def union_tables(*frames: DataFrame, source: list[str] | None = None) -> DataFrame:
    """Union by name; ``source`` tags each input."""
    if source:
        frames = [f.withColumn("source", F.lit(s)) for f, s in zip(frames, source)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def combine_alignments(first: DataFrame, second: DataFrame, order: list) -> DataFrame:
    """U4: the second set gets numbers after those of the first."""
    top = first.agg(F.coalesce(F.max("number"), F.lit(0).cast("long"))).scalar()
    moved = number_rows(second.drop("number"), order, "_rn").withColumn("number", F.col("_rn") + top).drop("_rn")
    return first.unionByName(moved.select(first.columns))


def join_abundance(abundance: DataFrame, tx2gene: DataFrame, ignore: DataFrame | None = None) -> DataFrame:
    """Expression with gene and location; listed ids are left out."""
    a = abundance if ignore is None else abundance.join(ignore.select("tx_id").distinct(), "tx_id", "left_anti")
    return a.join((tx2gene.select("tx_id", "gene_id", "location")), "tx_id")


def select_expressed(tx: DataFrame, frac: float, locus: str = "location") -> DataFrame:
    """Transcripts with at least ``frac`` of the best expression of their locus."""
    top = tx.groupBy(locus).agg(F.max("tpm").alias("_top"))
    return tx.join(top, locus).where(F.col("tpm") >= F.col("_top") * frac).drop("_top")


def best_expressed(tx: DataFrame, locus: str = "location") -> DataFrame:
    """One transcript per locus."""
    return tx.groupBy(locus).agg(F.max_by("tx_id", F.struct("tpm", "tx_id")).alias("tx_id"), F.max("tpm").alias("tpm"))


def select_training(models: DataFrame, keep: DataFrame, listed_only: bool = False, multi_only: bool = False) -> DataFrame:
    """Of overlapping models those that a better one (more parts, then least id) touches go.

    ``models(gene_id, contig, start, end, n_cds)``; ``listed_only`` takes models named in ``keep``,
    ``multi_only`` models of several parts. Few pairs are built: see ``best_of_islands``.
    """
    pool = models.join(keep.select("gene_id").distinct(), "gene_id", "left_semi") if listed_only else models
    pool = materialize((pool.where("n_cds > 1") if multi_only else pool).select("gene_id", "contig", "start", "end", "n_cds"), "pool")
    spans = pool.groupBy("contig", "start", "end").agg(F.min(F.struct((-F.col("n_cds")).alias("k"), "gene_id")).alias("r")).select("contig", "start", "end", "r.k", "r.gene_id")
    return pool.join(best_of_islands(spans).select("gene_id"), "gene_id", "left_semi")


def best_of_islands(spans: DataFrame, few: int = 200) -> DataFrame:
    """Spans ``(contig, start, end, k, gene_id)`` that overlap none of less ``k``, then ``gene_id``.

    Spans of an island of overlapping ones meet each other only. In islands of up to ``few`` spans they are
    compared, which takes no more than ``few`` pairs a span; crowded islands are ranked: see ``beaten_spans``.
    """
    line = Slabs(spans, ["contig"], ["start", "end"]).scan(("_reach", "max", F.col("end"), False))
    line.scan(("island", "last", F.when(F.coalesce(F.col("_reach") < F.col("start"), F.lit(True)), F.col("start")), True))
    placed = materialize(line.result().drop("_reach"), "placed")
    size = placed.groupBy("contig", "island").agg(F.count(F.lit(1)).alias("_n"))
    # a span without a contig meets nothing
    sized = materialize(placed.join(size, ["contig", "island"], "left").withColumn("_n", F.when(F.col("contig").isNull(), 1).otherwise(F.col("_n"))), "islands")
    own, other = sized.where(F.col("_n") <= few).alias("a"), sized.where((F.col("_n") > 1) & (F.col("_n") <= few)).alias("b")
    meets = (F.col("b.start") <= F.col("a.end")) & (F.col("b.end") >= F.col("a.start"))
    better = F.struct("b.k", "b.gene_id") < F.struct("a.k", "a.gene_id")
    kept = own.join(other, (F.col("a.contig") == F.col("b.contig")) & (F.col("a.island") == F.col("b.island")) & meets & better, "left_anti")
    out = kept.select(*spans.columns)
    crowded = sized.where(F.col("_n") > few).select(*spans.columns)
    if crowded.isEmpty():
        return out
    ranked = materialize(number_rows(crowded, ["k", "gene_id"], "rank", ["contig"]), "ranked")
    return out.unionByName(ranked.join(beaten_spans(ranked), ["contig", "start", "end"], "left_anti").select(*spans.columns))


def beaten_spans(spans: DataFrame) -> DataFrame:
    """Spans ``(contig, start, end, rank)`` that overlap one of lower rank (1 is best) on their contig.

    The ranks below a given one are the union of one block of 2^l ranks for each bit l set in it. A
    span stands in the block of its rank on every level and asks those blocks for an overlap, which
    is a running maximum: rows grow with n log n, however many spans lie on one place.
    """
    top = spans.groupBy("contig").agg(F.max("rank").alias("_top"))
    place = spans.join(top, "contig").withColumn("_r", F.col("rank") - 1).withColumn("level", F.explode(F.expr("sequence(0, length(bin(_top)) - 1)")))
    place = place.withColumn("block", F.expr("shiftright(_r, level)"))
    odd = F.col("block") % 2 == 1
    asks = place.where(odd).select("contig", "level", (F.col("block") - 1).alias("block"), "start", "end")
    marks = place.where(~odd).select("contig", "level", "block", "start", "end")
    return overlap_semi(asks, marks, ["contig", "level", "block"]).select("contig", "start", "end").distinct()


def busco_predictions(predictions: DataFrame, regions: DataFrame) -> DataFrame:
    """Predictions or evidence inside candidate regions."""
    return flag_overlap(predictions, regions, "in_region").where("in_region").drop("in_region")


def validate_trna(trnas: DataFrame, genes: DataFrame, gaps: DataFrame) -> DataFrame:
    """tRNAs that overlap neither genes nor gaps."""
    cols = ["contig", "start", "end"]
    return overlap_anti(trnas, genes.select(cols).unionByName(gaps.select(cols)))


def compatible(cds: Column, exons: Column) -> Column:
    """Every CDS part lies in the first exon it touches, sharing a border with it
    when the CDS has several parts; parts that touch no exon do not count."""
    def fits(c):
        hit = F.get(F.filter(exons, lambda e: (e["start"] <= c["end"]) & (e["end"] >= c["start"])), F.lit(0))
        inside = (c["start"] >= hit["start"]) & (c["end"] <= hit["end"])
        border = (F.size(cds) == 1) | (c["start"] == hit["start"]) | (c["end"] == hit["end"])
        return hit.isNull() | (inside & border)
    return (F.size(cds) <= F.size(exons)) & F.forall(cds, fits)


def _assign(options: dict[int, list[int]]) -> dict[int, int]:
    """First complete assignment in lexicographic order, by augmenting paths."""
    def complete(fixed: dict) -> bool:
        owner = {x: i for i, x in fixed.items()}
        def place(i, seen):
            for x in options[i]:
                if x in seen or owner.get(x) in fixed:
                    continue
                seen.add(x)
                if x not in owner or place(owner[x], seen):
                    owner[x] = i
                    return True
            return False
        return all(place(i, set()) for i in options if i not in fixed)

    chosen: dict = {}
    for i in options:
        for x in options[i]:
            if x not in chosen.values() and complete({**chosen, i: x}):
                chosen[i] = x
                break
    return chosen


def _assign_genes(batches):
    """One row per CDS list of the genes of a batch."""
    for batch in batches:
        out = []
        for gene, options in zip(batch["gene_id"].to_pylist(), batch["options"].to_pylist()):
            lists = {o["cds_no"]: o["fit"] for o in options}
            chosen = _assign(lists)
            out += [(gene, i, chosen.get(i)) for i in lists]
        kinds = [batch.schema.field("gene_id").type, *[batch.schema.field("options").type.value_type.field("cds_no").type] * 2]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["gene_id", "cds_no", "exon_no"])


def pair_cds_exons(cds: DataFrame, exons: DataFrame) -> DataFrame:
    """Exon list for every CDS list of a gene, ``(gene_id, cds_no, exon_no)``.

    A row holds the lists of one gene. Genes whose lists match in order are settled there, and
    those where each CDS list fits one exon list of its own; only the others are assigned.
    """
    kind = cds.schema["cds_no"].dataType
    lists = cds.groupBy("gene_id").agg(F.array_sort(F.collect_list(F.struct("cds_no", "cds"))).alias("c")).join(
        exons.groupBy("gene_id").agg(F.array_sort(F.collect_list(F.struct(F.col("exon_no").cast(kind).alias("exon_no"), "exons"))).alias("e")), "gene_id")
    fits = lambda x: F.transform(F.filter("e", lambda y: compatible(x["cds"], y["exons"])), lambda y: y["exon_no"])
    options = F.transform("c", lambda x: F.struct(x["cds_no"].alias("cds_no"), fits(x).alias("fit"), F.exists("e", lambda y: y["exon_no"] == x["cds_no"]).alias("twin")))
    genes = materialize(computed_once(lists, "options", options).select("gene_id", "options"), "fits")
    twins = F.filter("options", lambda o: o["twin"])
    ordered = (F.size(twins) > 0) & F.forall(twins, lambda o: F.array_contains(o["fit"], o["cds_no"]))
    only = F.flatten(F.transform("options", lambda o: o["fit"]))
    own = F.forall("options", lambda o: F.size(o["fit"]) == 1) & (F.size(F.array_distinct(only)) == F.size("options"))
    pair = lambda o, x: F.struct(o["cds_no"].alias("cds_no"), x.alias("exon_no"))
    pairs = F.when(ordered, F.transform(twins, lambda o: pair(o, o["cds_no"]))).when(own, F.transform("options", lambda o: pair(o, F.get(o["fit"], F.lit(0)))))
    settled = genes.where(ordered | own).select("gene_id", F.explode(pairs).alias("p")).select("gene_id", "p.*")
    return settled.unionByName(genes.where(~(ordered | own)).mapInArrow(_assign_genes, settled.schema))


def parse_weights(entries: list[str], known: dict[str, int] | None = None) -> tuple[dict[str, int], list[str]]:
    """``source:n`` entries (``n`` is 1 when left out) as weights, and the sources nobody knows."""
    table = known if known is not None else {k.lower(): v for k, v in DEFAULT_WEIGHTS.items()}
    weights, unknown = dict(table), []
    for entry in entries:
        source, _, n = entry.partition(":")
        if source.lower() in table:
            weights[source.lower()] = int(n) if n else 1
        else:
            unknown.append(source)
    return weights, unknown


def parse_model_files(entries: list[str], default: int = 1) -> list[tuple[str, str, int]]:
    """``file.gff3:5`` entries as (path, source name, weight); a colon inside the path stays."""
    out = []
    for i, entry in enumerate(entries):
        path, colon, n = entry.rpartition(":")
        path, weight = (path, int(n)) if colon and n.isdigit() else (entry, default)
        out.append((path, f"other_pred{i + 1}", weight))
    return out


def consensus_models(predictions: DataFrame, evidence: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """The non-overlapping models of greatest total support for each contig and strand.

    Support = weights of the sources that predict the same structure + 1 for evidence
    that covers 90 % of the model; sources without a weight count 1. ``predictions(name,
    contig, strand, start, end, source, chain)`` where ``chain`` is the text of its exon
    borders. A model that bridges two genes gives way to them when they have more support.
    """
    table = {**DEFAULT_WEIGHTS, **(weights or {})}
    weight = F.lit(1)
    for s, v in table.items():
        weight = F.when(F.lower("source") == s.lower(), v).otherwise(weight)
    once = predictions.groupBy("contig", "strand", "start", "end", "chain", "source").agg(F.min("name").alias("name"), F.max(weight).alias("w"))
    cand = once.groupBy("contig", "strand", "start", "end", "chain").agg(F.sum("w").cast("long").alias("w"), F.min("name").alias("name"))
    cand = materialize(cand, "models")
    seen = covered_spans(cand, evidence, 0.9).withColumn("_e", F.lit(1))
    scored = cand.join(seen, ["contig", "start", "end"], "left").withColumn("score", F.col("w") + F.coalesce("_e", F.lit(0)))
    return schedule(scored.select("contig", "strand", "start", "end", "score", "name")).select("contig", "strand", "name", "start", "end", "score")
