"""Feature, sequence, hint and report sinks.

``*_lines`` render rows; ``write_lines`` sorts them by range and writes part files
whose concatenation is the whole sorted file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import naming as N
from ..functions import sequence as S
from ..operators.annotations import go_category
from ..operators.models import cds_phase, valid_models
from ..operators.sequences import lengths
from ..scale import computed_once, materialize
from ..sources.pieces import cut

# Feature order inside one start position of a sorted GFF3 file.
FEATURE_RANK = ["gene", "mRNA", "transcript", "tRNA", "ncRNA", "rRNA", "pseudogene", "five_prime_UTR", "five_prime_utr", "exon", "three_prime_UTR",
                "three_prime_utr", "CDS"]


def write_lines(df: DataFrame, path: str, order: list, line: str = "line", header: str | None = None) -> None:
    """Range-sort by ``order`` and write one text column; the header sorts first."""
    rows = df.select(F.lit(1).alias("_h"), *[F.col(o) for o in order], F.col(line).alias("value"))
    if header is not None:
        top = df.sparkSession.range(1).select(F.lit(0).alias("_h"), *[F.lit(None).cast(df.schema[o].dataType).alias(o) for o in order], F.lit(header).alias("value"))
        rows = top.unionByName(rows)
    keys = ["_h"] + list(order)
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("value").write.text(path)


def in_order(df: DataFrame, order: list) -> DataFrame:
    """Range-sorted rows. Range sampling computes its input once more, so sort what lines are made from, not the lines."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def sort_gff(features: DataFrame) -> DataFrame:
    """O2: natural contig, start, feature rank; a global range sort."""
    rank = F.array_position(F.array(*[F.lit(x) for x in FEATURE_RANK]), F.col("feature"))
    rank = F.when(rank == 0, F.lit(99)).otherwise(rank)
    return features.withColumn("contig_key", S.natural_key(F.col("contig"))).withColumn("rank", rank.cast("int")).orderBy("contig_key", "start", "rank", "end")


def sort_bed(df: DataFrame) -> DataFrame:
    """O3."""
    return df.orderBy("contig", "start", "end")


def sort_hints(hints: DataFrame) -> DataFrame:
    """O3."""
    return hints.orderBy("contig", "feature", "end", "start")


def _row(contig, source, feature, start, end, strand, phase, attrs, score=None) -> Column:
    score = F.lit(".") if score is None else score
    return F.concat_ws("\t", contig, source, feature, start.cast("string"), end.cast("string"), score, strand, phase, attrs)


def _attrs(*pairs: Column) -> Column:
    return F.concat_ws("", *pairs)


def _maybe(key: str, values: Column) -> Column:
    return F.when(F.size(values) > 0, F.concat(F.lit(f"{key}="), F.array_join(values, ","), F.lit(";")))


def gff3_lines(models: DataFrame, utrs: bool = True, tpm: bool = False) -> DataFrame:
    """K1/K3: gene, transcript, UTR, exon and CDS lines with running phase."""
    return _gff3_text(_gff3_rows(models, utrs, tpm)).select("contig", "gene_start", "gene_id", "tx_id", "ord", "line")


def _gff3_rows(models: DataFrame, utrs: bool, tpm: bool) -> DataFrame:
    """A row for each gene (without a ``tx_id``) and transcript: its attributes ``_t`` and the places ``_parts`` of its lines."""
    ok = valid_models(models)
    ctg, src, st = F.col("contig"), F.col("source"), F.col("strand")
    none = F.array().cast("array<string>")
    syn = F.coalesce("synonyms", none)
    g = ok.groupBy("gene_id").agg(*[F.min(c).alias(c) for c in ("contig", "source", "strand", "gene_start", "gene_end", "name", "synonyms")])
    gattr = _attrs(F.concat(F.lit("ID="), "gene_id", F.lit(";")), F.when(F.col("name").isNotNull(), F.concat(F.lit("Name="), "name", F.lit(";"))), _maybe("Alias", syn))
    go = N.simplify_go(F.coalesce("go", none))
    extra = [F.when(F.col("tpm").isNotNull(), F.concat(F.lit("TPM="), F.col("tpm").cast("string"), F.lit(";")))] if tpm else []
    tattr = _attrs(F.concat(F.lit("ID="), "tx_id", F.lit(";Parent="), "gene_id", F.lit(";product="), F.coalesce("product", F.lit("None")), F.lit(";")), _maybe("Alias", syn),
                   _maybe("Ontology_term", go), _maybe("Dbxref", F.coalesce("dbxrefs", none)), _maybe("EC_number", F.coalesce("ec", none)),
                   _maybe("note", N.clean_notes(F.coalesce("notes", none))), *extra)
    # functions over lists are interpreted, so they only place the parts; the text of a line is made from its row
    place = lambda kind, start, end, no, phase: F.struct(F.lit(kind).alias("kind"), start.cast("long").alias("start"), end.cast("long").alias("end"), no.cast("int").alias("no"), phase.cast("int").alias("phase"))
    null = F.lit(None)
    genes = g.select("contig", "source", "strand", F.lit("gene").alias("type"), "gene_start", "gene_id", F.lit("").alias("tx_id"), gattr.alias("_t"), F.array(place(0, F.col("gene_start"), F.col("gene_end"), null, null)).alias("_parts"))
    turn = lambda a: F.when(st == "-", F.reverse(F.array_sort(a))).otherwise(F.array_sort(a))
    sub = lambda arr, kind: F.transform(arr, lambda e, i: place(kind, e["start"], e["end"], i + 1, null))
    u = F.col("_u")
    has = (F.size("cds") > 0) & F.lit(utrs)
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,no:int,phase:int>>")
    head = F.array(place(0, F.col("gene_start"), F.col("gene_end"), null, null))
    five, three = F.when(has, sub(turn(u["five"]), 1)).otherwise(empty), F.when(has, sub(turn(u["three"]), 2)).otherwise(empty)
    exon = F.when(F.col("type").isin("mRNA", "tRNA", "ncRNA"), sub(turn(F.col("exons")), 3)).otherwise(empty)
    cds = F.transform(cds_phase(F.col("cds"), st, F.coalesce("codon_start", F.lit(1))), lambda c: place(4, c["start"], c["end"], null, c["phase"]))
    cds = F.when(F.col("type") == "mRNA", cds).otherwise(empty)
    placed = computed_once(ok, "_u", S.utr_parts(F.col("exons"), F.col("cds"), F.col("strand"))).select(
        "contig", "source", "strand", "type", "gene_start", "gene_id", "tx_id", tattr.alias("_t"), F.concat(head, five, exon, three, cds).alias("_parts"))
    return genes.unionByName(placed)


def _gff3_text(rows: DataFrame) -> DataFrame:
    """The lines of the rows, in the order of the rows."""
    ctg, src, st = F.col("contig"), F.col("source"), F.col("strand")
    rows = rows.select(*[c for c in rows.columns if c != "_parts"], F.posexplode_outer("_parts").alias("ord", "_e"))
    kind, no = F.col("_e.kind"), F.col("_e.no")
    feature = F.when(kind == 0, F.col("type")).when(kind == 1, "five_prime_UTR").when(kind == 2, "three_prime_UTR").when(kind == 3, "exon").otherwise("CDS")
    suffix = F.when(kind == 1, F.concat(F.lit(".utr5p"), no)).when(kind == 2, F.concat(F.lit(".utr3p"), no)).when(kind == 3, F.concat(F.lit(".exon"), no)).otherwise(".cds")
    at = F.when(kind == 0, F.col("_t")).otherwise(F.concat(F.lit("ID="), "tx_id", suffix, F.lit(";Parent="), "tx_id", F.lit(";")))
    phase = F.when(kind == 4, F.col("_e.phase").cast("string")).otherwise(".")
    line = F.when(F.col("_e").isNotNull(), _row(ctg, src, feature, F.col("_e.start"), F.col("_e.end"), st, phase, at))
    return rows.withColumn("line", line)


def write_gff3(models: DataFrame, path: str, utrs: bool = True, tpm: bool = False) -> None:
    """K1: sorted part files; genes and transcripts are sorted, their lines are made in place."""
    rows = _gff3_rows(models, utrs, tpm).select(F.lit(1).alias("_h"), S.natural_key(F.col("contig")).alias("_key"), "*")
    top = models.sparkSession.range(1).select(F.lit(0).alias("_h"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns[1:]])
    out = _gff3_text(in_order(top.unionByName(rows), ["_h", "_key", "gene_start", "gene_id", "tx_id"]))
    out.select(F.when(F.col("_h") == 0, "##gff-version 3").otherwise(F.col("line")).alias("value")).write.text(path)


def gtf_lines(models: DataFrame) -> DataFrame:
    """K2: start/stop codons, exons and CDS (the stop codon is not part of the last CDS)."""
    ok = valid_models(models).where("type = 'mRNA'")
    ctg, src, st = F.col("contig"), F.col("source"), F.col("strand")
    at = F.concat(F.lit('transcript_id "'), "tx_id", F.lit('"; gene_id "'), "gene_id", F.lit('";'))
    zero = F.lit("0")
    plus = st == "+"
    parts = cds_phase(F.col("cds"), st, F.coalesce("codon_start", F.lit(1)))
    n = F.size("cds")
    first, last = F.element_at(parts, 1), F.element_at(parts, -1)
    s0 = F.when(plus, first["start"]).otherwise(first["end"] - 2)
    e0 = F.when(plus, last["end"] - 2).otherwise(last["start"])
    # functions over lists are interpreted, so they only place the parts; the text of a line is made from its row
    place = lambda kind, start, end, phase: F.struct(F.lit(kind).alias("kind"), start.cast("long").alias("start"), end.cast("long").alias("end"), phase.alias("phase"))
    start = F.when(~F.col("partial_start"), F.array(place("start_codon", s0, s0 + 2, zero)))
    stop = F.when(~F.col("partial_stop"), F.array(place("stop_codon", e0, e0 + 2, zero)))
    cut = lambda c, i: F.struct(F.when(~plus & (i == n - 1) & ~F.col("partial_stop"), c["start"] + 3).otherwise(c["start"]).alias("start"),
                                F.when(plus & (i == n - 1) & ~F.col("partial_stop"), c["end"] - 3).otherwise(c["end"]).alias("end"), c["phase"].alias("phase"))
    cds = F.transform(F.filter(F.transform(parts, cut), lambda c: c["end"] >= c["start"]), lambda c: place("CDS", c["start"], c["end"], c["phase"].cast("string")))
    turn = F.when(st == "-", F.reverse(F.array_sort("exons"))).otherwise(F.array_sort("exons"))
    exon = F.transform(turn, lambda e: place("exon", e["start"], e["end"], F.lit(".")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,phase:string>>")
    rows = F.concat(F.coalesce(start, none), cds, F.coalesce(stop, none), exon)
    keep = ["contig", "source", "strand", "gene_start", "gene_id", "tx_id"]
    rows = ok.select(*keep, rows.alias("_parts")).select(*keep, F.posexplode_outer("_parts").alias("ord", "_e"))
    line = F.when(F.col("_e").isNotNull(), _row(ctg, src, F.col("_e.kind"), F.col("_e.start"), F.col("_e.end"), st, F.col("_e.phase"), at, zero))
    return rows.select("contig", "gene_start", "gene_id", "tx_id", "ord", line.alias("line"))


def write_gtf(models: DataFrame, path: str) -> None:
    rows = models.drop("transcript", "cds_seq", "protein").withColumn("_key", S.natural_key(F.col("contig")))
    gtf_lines(in_order(rows, ["_key", "gene_start", "gene_id", "tx_id"])).select(F.col("line").alias("value")).write.text(path)


def _coord_lines(parts: Column, plus: Column, kind: Column, left: Column, right: Column) -> Column:
    """Submission-table coordinate lines in reading order with partial markers."""
    ordered = F.when(plus, F.array_sort(parts)).otherwise(F.reverse(F.array_sort(parts)))
    n = F.size(parts)
    def one(e, i):
        a, b = F.when(plus, e["start"]).otherwise(e["end"]), F.when(plus, e["end"]).otherwise(e["start"])
        return F.concat(F.when(i == 0, left).otherwise(""), a.cast("string"), F.lit("\t"), F.when(i == n - 1, right).otherwise(""), b.cast("string"), F.when(i == 0, F.concat(F.lit("\t"), kind)).otherwise(""))
    return F.transform(ordered, one)


def with_go_lines(models: DataFrame, terms: DataFrame) -> DataFrame:
    """K4: adds ``go_lines``, the formatted GO qualifiers of every transcript."""
    flat = models.select("tx_id", F.explode_outer("go").alias("go_id")).where("go_id is not null")
    lines = go_category(flat, terms).groupBy("tx_id").agg(F.array_sort(F.collect_set("line")).alias("go_lines"))
    return models.join(lines, "tx_id", "left")


def tbl_blocks(models: DataFrame, transl_table: int = 1) -> DataFrame:
    """K4: one text block per gene: gene, mRNA and CDS features of its ranked transcripts.

    Needs ``rank`` (see ``order_transcripts``), ``new_tx_id`` and the partial flags;
    ``go_lines`` (see ``with_go_lines``) are written when present.
    """
    ok = valid_models(models)
    st = F.col("strand") == "+"
    q = lambda k, v: F.concat(F.lit(f"\t\t\t{k}\t"), v)
    lt, gt = F.when(F.col("partial_start"), "<").otherwise(""), F.when(F.col("partial_stop"), ">").otherwise("")
    ids = F.array(q("transcript_id", F.concat(F.lit("gnl|ncbi|"), "new_tx_id", F.lit("_mrna"))), q("protein_id", F.concat(F.lit("gnl|ncbi|"), "new_tx_id")))
    product = F.array(q("product", F.coalesce("product", F.lit("hypothetical protein"))))
    none = F.array().cast("array<string>")
    rep = lambda k, c: F.transform(F.coalesce(c, none), lambda x: F.concat(F.lit(f"\t\t\t{k}\t"), x))
    go = F.transform(F.coalesce("go_lines", none), lambda x: F.concat(F.lit("\t\t\t"), x)) if "go_lines" in models.columns else none
    func = F.concat(rep("EC_number", F.filter(F.coalesce("ec", none), lambda x: N.valid_ec(x))), rep("db_xref", F.col("dbxrefs")), go, rep("note", F.col("notes")))
    table = F.array(q("transl_table", F.lit(str(transl_table)))) if transl_table != 1 else none
    codon = F.array(q("codon_start", F.coalesce("codon_start", F.lit(1)).cast("string")))
    coding = F.concat(_coord_lines(F.col("exons"), st, F.lit("mRNA"), lt, gt), product, ids, _coord_lines(F.col("cds"), st, F.lit("CDS"), lt, gt), codon, table, func, product, ids)
    other = F.concat(_coord_lines(F.col("exons"), st, F.col("type"), F.lit(""), F.lit("")), product, F.when(F.col("product") == "tRNA-Xxx", F.array(F.lit("\t\t\tpseudo"))).otherwise(none))
    tx = ok.withColumn("_l", F.when(F.col("type") == "mRNA", coding).otherwise(other))
    g = tx.groupBy("gene_id").agg(
        *[F.min(c).alias(c) for c in ("contig", "strand", "gene_start", "gene_end", "name", "synonyms")], F.bool_or("partial_start").alias("ps"), F.bool_or("partial_stop").alias("pe"),
        F.sort_array(F.collect_list(F.struct("rank", "_l"))).alias("tx"))
    a = F.when(st, F.col("gene_start")).otherwise(F.col("gene_end")).cast("string")
    b = F.when(st, F.col("gene_end")).otherwise(F.col("gene_start")).cast("string")
    head = F.array(F.concat(F.when(F.col("ps"), "<").otherwise(""), a, F.lit("\t"), F.when(F.col("pe"), ">").otherwise(""), b, F.lit("\tgene")))
    named = F.when(F.col("name").isNotNull(), F.array(q("gene", F.col("name")))).otherwise(none)
    lines = F.concat(head, named, rep("gene_synonym", F.col("synonyms")), F.array(q("locus_tag", F.col("gene_id"))), F.flatten(F.transform("tx", lambda t: t["_l"])))
    return g.select("contig", "gene_start", "gene_id", F.array_join(lines, "\n").alias("line"))


TBL_PIECE = 10_000_000
TBL_GENES = 1000


def tbl_lines(models: DataFrame, sequences: DataFrame, center: str = "CENTER", version: str = "12345", transl_table: int = 1) -> DataFrame:
    """K4: contig headers with their reference span, then the gene blocks.

    A contig is written in pieces of fixed span, each under its own header, so that a
    huge contig can be sorted and written by many tasks; the reference line stands in
    the first piece only.
    """
    body = tbl_blocks(models, transl_table).withColumn("piece", F.floor(F.col("gene_start") / TBL_PIECE))
    used = body.select("contig", "piece").distinct()
    first = used.groupBy("contig").agg(F.min("piece").alias("p0"))
    lens = sequences.select(F.col("seq_id").alias("contig"), F.length("seq").alias("n"))
    ref = F.when(F.col("piece") == F.col("p0"), F.concat(F.lit("\n1\t"), "n", F.lit(f"\tREFERENCE\n\t\t\t{center}\t{version}"))).otherwise("")
    head = used.join(first, "contig").join(lens, "contig").select(
        "contig", "piece", F.lit(-1).cast("long").alias("gene_start"), F.lit("").alias("gene_id"), F.concat(F.lit(">Feature "), "contig", ref).alias("line"))
    return head.unionByName(body)


def write_tbl(models: DataFrame, sequences: DataFrame, path: str, **kw) -> None:
    """K4: sorted part files. The header line stands again after every ``TBL_GENES`` rows of a file, so that
    genes crowded on one contig neither fill one task nor one block of the reader."""
    order = ["key", "contig", "piece", "gene_start", "gene_id"]
    out = tbl_lines(models, sequences, **kw).withColumn("key", S.natural_key(F.col("contig"))).repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) % TBL_GENES
    head = F.when((at == 0) & (F.col("gene_start") >= 0), F.concat(F.lit(">Feature "), "contig", F.lit("\n"))).otherwise("")
    out.select(F.concat(head, "line").alias("value")).write.text(path)


def fasta_lines(df: DataFrame, header: str = "seq_id", seq: str = "seq", protein: bool = False, width: int = 80) -> DataFrame:
    """K6: header and wrapped sequence; a trailing stop is cut from proteins."""
    text = F.regexp_replace(F.col(seq), r"\*$", "") if protein else F.col(seq)
    return df.withColumn("line", F.concat(F.lit(">"), F.col(header), F.lit("\n"), S.wrap(text, width)))


def write_fasta(df: DataFrame, path: str, order: list | None = None, **kw) -> None:
    fasta_lines(in_order(df, order) if order else df, **kw).select("line").write.text(path)


def export_all(models: DataFrame, sequences: DataFrame, folder: str, transl_table: int = 1) -> None:
    """K5: submission table, GFF3, GTF, protein, transcript, CDS and scaffold files.

    Seven outputs share the models, so they are computed and written once first.
    """
    models = materialize(models, "models")
    write_tbl(models, sequences, f"{folder}/tbl", transl_table=transl_table)
    write_gff3(models, f"{folder}/gff3")
    write_gtf(models, f"{folder}/gtf")
    coding = models.where("type = 'mRNA'")
    stranded = F.when(F.col("strand") == "-", S.revcomp(F.col("transcript"))).otherwise(F.col("transcript"))
    write_fasta(coding.select("tx_id", "protein"), f"{folder}/proteins", ["tx_id"], header="tx_id", seq="protein", protein=True)
    write_fasta(in_order(models.select("tx_id", "strand", "transcript"), ["tx_id"]).select("tx_id", stranded.alias("seq")), f"{folder}/transcripts", header="tx_id")
    write_fasta(coding.select("tx_id", "cds_seq"), f"{folder}/cds", ["tx_id"], header="tx_id", seq="cds_seq")
    write_fasta(sequences.select("seq_id", "seq"), f"{folder}/scaffolds", ["seq_id"])


def hint_lines(hints: DataFrame) -> DataFrame:
    """K7."""
    at = F.concat(F.lit("grp="), "grp", F.lit(";pri="), "pri", F.lit(";src="), "src")
    return hints.withColumn("line", F.concat_ws("\t", "contig", F.lit("b2h"), "feature", "start", "end", F.col("score").cast("string"), "strand", F.lit("."), at))


def write_hints(hints: DataFrame, path: str) -> None:
    write_lines(hint_lines(hints), path, ["contig", "feature", "end", "start"])


def alignment_lines(expanded: DataFrame) -> DataFrame:
    """K8: one line per aligned exon with its target range."""
    rows = expanded.select("target", "query", "strand", "pident", F.explode_outer("exons").alias("e"))
    at = F.concat(F.lit("ID="), "query", F.lit(";Target="), "query", F.lit(" "), F.col("e.qstart"), F.lit(" "), F.col("e.qend"))
    return rows.select(F.col("target").alias("contig"), F.col("e.start").alias("start"), "query", F.concat_ws(
        "\t", "target", F.lit("genome"), F.lit("cDNA_match"), "e.start", "e.end", F.format_string("%.2f", "pident"), "strand", F.lit("."), at).alias("line"))


def bed_to_gff3(df: DataFrame, source: str = "repeats", feature: str = "dispersed_repeat") -> DataFrame:
    """K9: one line per span (internally 1-based, so no shift is needed)."""
    return df.withColumn("line", F.concat_ws("\t", "contig", F.lit(source), F.lit(feature), "start", "end", F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit("ID="), "name")))


def bed_lines(df: DataFrame) -> DataFrame:
    return df.withColumn("line", F.concat_ws("\t", "contig", F.col("start") - 1, "end", "name"))


def annotation_table(models: DataFrame, channels: DataFrame, headers: list[str]) -> DataFrame:
    """One row per transcript, one ``;``-joined column per channel in ``headers``.

    ``channels(tx_id, channel, hit)`` comes from ``route_notes``; values are distinct
    and sorted inside a cell.
    """
    cell = lambda k: F.array_join(F.array_sort(F.collect_set(F.when(F.col("channel") == k, F.col("hit")))), ";")
    wide = channels.where(F.col("channel").isin(*headers)).groupBy("tx_id").agg(*[cell(k).alias(k) for k in headers])
    return models.join(wide, "tx_id", "left").fillna("", headers)


# Columns of the annotation table and category names.
TABLE_COLUMNS = ["GeneID", "TranscriptID", "Feature", "Contig", "Start", "Stop", "Strand", "Name", "Product", "Alias/Synonyms", "EC_number", "BUSCO", "PFAM", "InterPro", "EggNog", "COG",
                 "GO Terms", "Secreted", "Membrane", "Protease", "CAZyme"]
TABLE_NOTES = {"BUSCO": "BUSCO", "EggNog": "EggNog", "Secreted": "SECRETED", "Membrane": "TransMembrane", "CAZyme": "CAZy"}
COG_NAMES = {
    "J": "(J) Translation, ribosomal structure and biogenesis", "A": "(A) RNA processing and modification", "K": "(K) Transcription",
    "L": "(L) Replication, recombination and repair", "B": "(B) Chromatin structure and dynamics", "D": "(D) Cell cycle control, cell division, chromosome partitioning",
    "Y": "(Y) Nuclear structure", "V": "(V) Defense mechanisms", "T": "(T) Signal transduction mechanisms", "M": "(M) Cell wall/membrane/envelope biogenesis", "N": "(N) Cell motility",
    "Z": "(Z) Cytoskeleton", "W": "(W) Extracellular structures", "U": "(U) Intracellular trafficking, secretion, and vesicular transport",
    "O": "(O) Posttranslational modification, protein turnover, chaperones", "C": "(C) Energy production and conversion", "G": "(G) Carbohydrate transport and metabolism",
    "E": "(E) Amino acid transport and metabolism", "F": "(F) Nucleotide transport and metabolism", "H": "(H) Coenzyme transport and metabolism", "I": "(I) Lipid transport and metabolism",
    "P": "(P) Inorganic ion transport and metabolism", "Q": "(Q) Secondary metabolites biosynthesis, transport and catabolism", "R": "(R) General function prediction only", "S": "(S) Function unknown",
}


def full_annotation_table(models: DataFrame, interpro: DataFrame, merops: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per transcript with the fixed columns, one for each ``extra`` note header, the
    other notes and four sequences.

    ``models``: transcripts with ``notes, dbxrefs, go, ec, synonyms`` lists and the oriented
    ``gdna, transcript, cds_seq, protein``; ``interpro`` and ``merops``: ``(term, description)``.
    A cell lists what one transcript carries; peptidases without a family are left out.
    """
    of = lambda c, p: F.transform(F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: x.startswith(f"{p}:")), lambda x: F.substring(x, F.lit(len(p) + 2), F.length(x)))
    cell = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), ";")

    def looked_up(column: str, prefix: str, lookup: DataFrame, name: str) -> DataFrame:
        hits = models.select("tx_id", F.posexplode(of(column, prefix)).alias("at", "hit"))
        named = hits.join(lookup.select(F.col("term").alias("hit"), "description"), "hit", "left")
        text = F.concat_ws(" ", "hit", F.coalesce("description", F.lit("None"))) if prefix == "InterPro" else F.col("description")
        rows = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct("at", text.alias("text")))))
        return named.groupBy("tx_id").agg(F.array_join(F.transform(rows, lambda x: x["text"]), ";").alias(name))

    m = models.join(looked_up("dbxrefs", "InterPro", interpro, "_ipr"), "tx_id", "left").join(looked_up("notes", "MEROPS", merops, "_mer"), "tx_id", "left")
    cogs = F.create_map(*[F.lit(x) for pair in COG_NAMES.items() for x in pair])
    cog = F.transform(F.flatten(F.transform(of("notes", "COG"), lambda x: F.split(x, ","))), lambda x: F.concat(x, F.lit(":"), cogs[x]))
    known = [*TABLE_NOTES.values(), "MEROPS", "COG", *extra]
    rest = F.filter(F.coalesce("notes", F.array().cast("array<string>")), lambda x: ~reduce(lambda a, b: a | b, [x.startswith(f"{k}:") for k in known]))
    coding = lambda c: F.when(F.col("type") == "mRNA", F.col(c))
    notes = {k: cell(of("notes", v)) for k, v in TABLE_NOTES.items()}
    values = {
        "GeneID": F.col("gene_id"), "TranscriptID": F.col("tx_id"), "Feature": F.col("type"), "Contig": F.col("contig"), "Start": F.col("gene_start").cast("string"),
        "Stop": F.col("gene_end").cast("string"), "Strand": F.col("strand"), "Name": F.col("name"), "Product": F.col("product"), "Alias/Synonyms": cell(F.col("synonyms")),
        "EC_number": cell(F.col("ec")), "PFAM": cell(of("dbxrefs", "PFAM")), "InterPro": F.col("_ipr"), "COG": cell(cog), "GO Terms": cell(F.col("go")), "Protease": F.col("_mer"), **notes}
    tail = {**{k: cell(of("notes", k)) for k in extra}, "Notes": cell(rest), "gDNA": F.col("gdna"), "mRNA": F.col("transcript"), "CDS-transcript": coding("cds_seq"), "Translation": coding("protein")}
    return m.select(*[F.coalesce(c, F.lit("")).alias(k) for k, c in [*((k, values[k]) for k in TABLE_COLUMNS), *tail.items()]])


def stats_json(df: DataFrame) -> DataFrame:
    """The one-row statistics tables as a JSON document."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def stats_document(**sections: DataFrame) -> DataFrame:
    """One JSON document with a nested section for each one-row table; a dictionary of
    tables nests further."""
    def struct(parts: dict):
        return F.struct(*[(struct(v) if isinstance(v, dict) else v.select(F.struct(*v.columns)).scalar()).alias(k) for k, v in parts.items()])

    first = next(v for v in sections.values() if not isinstance(v, dict))
    return first.sparkSession.range(1).select(F.to_json(struct(sections)).alias("json"))


def agp_lines(parts: DataFrame) -> DataFrame:
    """AGP rows of scaffold parts; ``contig`` names the sequence parts."""
    n = F.col("end") - F.col("start") + 1
    tail = F.when(F.col("kind") == "N", F.concat_ws("\t", F.lit("N"), n, F.lit("scaffold"), F.lit("yes"), F.lit("paired-ends"))).otherwise(
        F.concat_ws("\t", F.lit("W"), "contig", F.lit(1), n, F.lit("+")))
    return parts.withColumn("line", F.concat_ws("\t", "seq_id", "start", "end", "part", tail))


def cluster_report(genes: DataFrame, clusters: DataFrame, mibig: DataFrame, flank: int = 15_000) -> DataFrame:
    """Genes in and around every cluster, with the best reference-cluster hit."""
    from ..operators.intervals import overlap_join
    wide = clusters.select("contig", F.greatest(F.col("start") - flank, F.lit(1).cast("long")).alias("start"), (F.col("end") + flank).alias("end"),
                           F.col("start").alias("c0"), F.col("end").alias("c1"), F.col("name").alias("cluster"))
    j = overlap_join(genes, wide)
    inside = (F.col("start") <= F.col("b_c1")) & (F.col("end") >= F.col("b_c0"))
    best = mibig.groupBy("gene_id").agg(F.min_by("subject", F.struct("evalue", "subject")).alias("mibig"))
    return (j.select("gene_id", "contig", "start", "end", F.col("b_cluster").alias("cluster"), F.when(inside, "cluster").otherwise("flanking").alias("place"))
            .join(best, "gene_id", "left").withColumn("mibig", F.coalesce("mibig", F.lit("."))))


def smurf_rows(genes: DataFrame) -> DataFrame:
    """Locus, contig number, ends in reading order, product."""
    plus = F.col("strand") == "+"
    num = F.regexp_replace(F.regexp_replace("contig", r"\D", ""), "^0+", "")
    return genes.select("gene_id", num.alias("contig_no"), F.when(plus, F.col("start")).otherwise(F.col("end")).alias("from_pos"),
                        F.when(plus, F.col("end")).otherwise(F.col("start")).alias("to_pos"), F.coalesce("product", F.lit("No Description")).alias("product"))


def ortholog_inputs(models: DataFrame) -> DataFrame:
    """CDS lines for the ortholog search."""
    m = models.where("type = 'mRNA'")
    at = F.concat(F.lit("ID="), "tx_id", F.lit(";Parent="), "gene_id", F.lit(";product="), F.coalesce("product", F.lit("None")), F.lit(";"))
    return m.select("tx_id", _row(F.col("contig"), F.col("source"), F.lit("CDS"), F.col("gene_start"), F.col("gene_end"), F.col("strand"), F.lit("."), at).alias("line"))


def ortholog_proteins(models: DataFrame, protein: str = "protein") -> DataFrame:
    """Protein records named by transcript and gene; the sequence stays on one line."""
    m = models.where("type = 'mRNA'")
    return m.select("tx_id", F.concat(F.lit(">"), "tx_id", F.lit(" "), "gene_id", F.lit("\n"), F.col(protein)).alias("line"))


def ortholog_transcripts(models: DataFrame, cds: str = "cds_seq", codon_start: str = "codon_start") -> DataFrame:
    """Coding sequences named by transcript and gene, with reading start and strand."""
    m = models.where("type = 'mRNA'")
    head = F.concat(F.lit(">"), "tx_id", F.lit(" "), "gene_id", F.lit(" codon_start="), F.col(codon_start), F.lit(" strand="), "strand")
    return m.select("tx_id", F.concat(head, F.lit("\n"), F.col(cds)).alias("line"))


def smurf_proteins(models: DataFrame, protein: str = "protein") -> DataFrame:
    """Wrapped protein records named by gene, without trailing stops."""
    text = S.wrap(F.regexp_replace(F.col(protein), r"\*+$", ""))
    return models.where("type = 'mRNA'").select("gene_id", "tx_id", F.concat(F.lit(">"), "gene_id", F.lit("\n"), text).alias("line"))


def splice_sites(models: DataFrame) -> DataFrame:
    """0-based donor/acceptor pairs of multi-exon transcripts."""
    n = F.size("exons")
    pair = F.zip_with(F.slice("exons", 1, n - 1), F.slice("exons", 2, n - 1), lambda l, r: F.struct((l["end"] - 1).alias("left"), (r["start"] - 1).alias("right")))
    return models.where(n > 1).select("tx_id", "contig", "strand", F.explode_outer(pair).alias("p")).select("tx_id", "contig", "p.left", "p.right", "strand").distinct()


def exon_rows(models: DataFrame) -> DataFrame:
    """0-based exon ends."""
    return models.where(F.size("exons") > 1).select("tx_id", "contig", "strand", F.explode_outer("exons").alias("e")).select(
        "tx_id", "contig", (F.col("e.start") - 1).alias("left"), (F.col("e.end") - 1).alias("right"), "strand")


def product_table(models: DataFrame) -> DataFrame:
    """First product per locus that is not the default text."""
    m = models.where(F.col("product").isNotNull() & (F.col("product") != "hypothetical protein"))
    return m.groupBy("gene_id").agg(F.min_by("product", "tx_id").alias("product"))


# no FASTA id holds a blank
SHORT = "short contigs"


def fasta_blocks(sequences: DataFrame, width: int = 80, size: int = 65_600) -> DataFrame:
    """``seq_id``, ``piece`` and ``value``: wrapped FASTA text of sequences or of a piece table, one row
    for each ``size`` letters (a multiple of ``width``), so that lines run on across rows."""
    step = size // width * width
    if "chunk" in sequences.columns:
        parts = cut(sequences.select("seq_id", F.col("offset").alias("from"), F.col("chunk").alias("t")), ["seq_id"], step)
    else:
        parts = sequences.select("seq_id", F.posexplode(F.when(F.length("seq") == 0, F.array(F.lit(""))).otherwise(F.regexp_extract_all("seq", F.lit("(?s).{1,%d}" % step), F.lit(0)))).alias("piece", "chunk"))
    text = S.wrap(F.col("chunk"), width)
    return parts.select("seq_id", F.col("piece").cast("long").alias("piece"), F.when(F.col("piece") == 0, F.concat(F.lit(">"), "seq_id", F.lit("\n"), text)).otherwise(text).alias("value"))


def write_fasta_blocks(sequences: DataFrame, path: str, width: int = 80, size: int = 65_600) -> None:
    """K6 for contigs of any length: part files in natural order of the ids, a long contig over many of them."""
    rows = fasta_blocks(sequences, width, size).withColumn("key", S.natural_key(F.col("seq_id")))
    rows.repartitionByRange("key", "seq_id", "piece").sortWithinPartitions("key", "seq_id", "piece").select("value").write.text(path)


def write_partitioned(sequences: DataFrame, path: str, width: int = 80, size: int = 65_600, own: int = 1_000_000) -> None:
    """One folder per contig of ``own`` letters or more (0: per contig); shorter ones share the folder
    ``SHORT``, as a file for each of very many short contigs costs far more than its letters. A contig or
    folder is dealt over several tasks and part files in order."""
    rows = fasta_blocks(sequences, width, size).withColumnRenamed("seq_id", "_id")
    folder = F.col("_id")
    if own > 0:
        long = lengths(sequences).where(F.col("length") >= own).select(F.col("seq_id").alias("_id"), F.lit(True).alias("_long"))
        rows, folder = rows.join(long, "_id", "left"), F.when(F.col("_long"), F.col("_id")).otherwise(SHORT)
    order = ["seq_id", "_id", "piece"]
    rows = rows.select(folder.alias("seq_id"), "_id", "piece", "value").repartitionByRange(*order).sortWithinPartitions(*order)
    rows.select("seq_id", "value").write.partitionBy("seq_id").text(path)


def training_rows(models: DataFrame) -> DataFrame:
    """CDS parts in reading order as Einit / Exon / Eterm, ends swapped on minus."""
    plus = F.col("strand") == "+"
    ordered = F.when(plus, F.array_sort("cds")).otherwise(F.reverse(F.array_sort("cds")))
    n = F.size("cds")
    rows = models.where("type = 'mRNA'").select("contig", "tx_id", "strand", n.alias("n"), F.posexplode_outer(ordered).alias("i", "c")).where("c is not null")
    label = F.when(F.col("i") == 0, "Einit").when(F.col("i") == F.col("n") - 1, "Eterm").otherwise("Exon")
    return rows.select("contig", "tx_id", (F.col("i") + 1).alias("no"), label.alias("label"), F.when(F.col("strand") == "+", F.col("c.start")).otherwise(F.col("c.end")).alias("from_pos"),
                       F.when(F.col("strand") == "+", F.col("c.end")).otherwise(F.col("c.start")).alias("to_pos"))


def zff_lines(models: DataFrame) -> DataFrame:
    """Training rows under a header line for each contig; order by contig, transcript and number."""
    rows = training_rows(models)
    heads = rows.select("contig").distinct().select("contig", F.lit("").alias("tx_id"), F.lit(0).alias("no"), F.concat(F.lit(">"), "contig").alias("line"))
    return heads.unionByName(rows.select("contig", "tx_id", "no", F.concat_ws("\t", "label", "from_pos", "to_pos", "tx_id").alias("line")))


def spaced_lines(models: DataFrame) -> DataFrame:
    """Contig and ends of every CDS part in reading order, one text for each gene, closed by an empty line."""
    parts = training_rows(models).join(models.select("tx_id", "gene_id").distinct(), "tx_id")
    row = F.struct("tx_id", "no", F.concat_ws(" ", "contig", "from_pos", "to_pos").alias("line"))
    lines = F.array_sort(F.collect_list(row))
    return parts.groupBy("gene_id").agg(F.concat(F.array_join(F.transform(lines, lambda x: x["line"]), "\n"), F.lit("\n")).alias("line"))
