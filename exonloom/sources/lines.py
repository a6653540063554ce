"""Line-oriented formats; all parsing is built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scale import computed_once

# Feature kinds that gene models are built from.
MODEL_FEATURES = ["gene", "mRNA", "exon", "CDS", "tRNA", "ncRNA", "rRNA", "pseudogene", "five_prime_UTR", "five_prime_utr",
                  "three_prime_UTR", "three_prime_utr", "transcript"]
BLAST_TAB_14 = "sseqid slen sstart send qseqid qlen qstart qend pident length evalue score qcovhsp qframe".split()
BLAST_TAB_12 = BLAST_TAB_14[:12]
PAF_COLUMNS = "query qlen qstart qend strand target tlen tstart tend matches alnlen mapq".split()
# Header names of the three search-annotation layouts, and the
# column positions that a file without a header has.
EGGNOG_LAYOUTS = {
    1: {"query": "query_name", "tax": "annotation_tax_scope", "ogs": "ogs", "symbol": "predicted_gene_name", "cogs": "cog cat", "description": "eggnog annot"},
    2: {"query": "#query", "tax": "best_og_name", "ogs": "eggnog ogs", "symbol": "preferred_name", "cogs": "best_og_cat", "description": "best_og_desc", "ec": "ec"},
    3: {"query": "#query", "tax": "max_annot_lvl", "ogs": "eggnog_ogs", "symbol": "preferred_name", "cogs": "cog_category", "description": "description", "ec": "ec"},
}
EGGNOG_POSITIONS = {"query": 0, "tax": 8, "ogs": 9, "symbol": 4, "cogs": 11, "description": 12}


def lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def _data(df: DataFrame, comment: str = "#") -> DataFrame:
    return df.where((F.trim("value") != "") & ~F.col("value").startswith(comment))


def _cells(df: DataFrame, cells: Column) -> DataFrame:
    """The split line as column ``p``, split exactly once per line."""
    return computed_once(df.select("value"), "p", cells).select("p")


def _col(parts: Column, i: int, kind: str | None = None) -> Column:
    c = F.get(parts, F.lit(i))
    # a failing cast costs an exception, and a dot stands for no value in most columns
    return F.when(c != ".", c.try_cast(kind)) if kind else c


def _unquote(c: Column) -> Column:
    """Percent-decoding that leaves a literal plus alone."""
    return F.when(c.contains("%"), F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)).otherwise(c)


def _attr(info: Column, *keys: str) -> Column:
    """Value of the last attribute with one of the keys, by plain searches in ``;key=value;`` text."""
    last = None
    for k in keys:
        rest = F.when(info.contains(f";{k}="), F.substring_index(info, f";{k}=", -1))
        last = rest if last is None else F.when(last.isNull() | (F.length(rest) < F.length(last)), rest).otherwise(last)
    return F.substring_index(last, ";", 1)


def _list(c: Column) -> Column:
    return F.coalesce(F.split(c, ","), F.array().cast("array<string>"))


def parse_gff3(df: DataFrame) -> DataFrame:
    """S3: nine columns with typed attributes; comments and short lines dropped."""
    p = F.split("value", "\t")
    base = _cells(_data(df), p).where(F.size("p") == 9)
    a = _col(F.col("p"), 8)
    close = F.when(a.contains("; ") | a.contains(" ;"), F.regexp_replace(a, " *; *", ";")).otherwise(a)
    base = computed_once(base, "_info", F.concat(F.lit(";"), F.trim(close), F.lit(";")))
    info, c = F.col("_info"), F.col("p")
    # most lines hold an id and a parent only (two equal signs): no other key is looked for in them
    plain = info.contains(";ID=") & info.contains(";Parent=") & (F.substring_index(info, "=", 3) == info)
    base = computed_once(base, "_rest", F.when(plain, ";").otherwise(info))
    rows = base.select(
        _col(c, 0).alias("contig"), _col(c, 1).alias("source"), _col(c, 2).alias("feature"), _col(c, 3, "long").alias("start"), _col(c, 4, "long").alias("end"),
        _col(c, 5, "double").alias("score"), _col(c, 6).alias("strand"), _col(c, 7, "int").alias("phase"), info.alias("info"), F.col("_rest").alias("rest"), _col(c, 8).alias("attributes"))
    i = F.col("rest")
    parent = _attr(F.col("info"), "Parent")
    return rows.select(
        "contig", "source", "feature", "start", "end", "score", "strand", "phase", _attr(F.col("info"), "ID").alias("id"),
        F.when(parent.isNotNull(), F.split(parent, ",")).alias("parents"), _attr(i, "Name").alias("name"),
        _unquote(_attr(i, "Product", "product", "description")).alias("product"), _list(_attr(i, "Note", "note")).alias("notes"),
        _list(_attr(i, "Dbxref")).alias("dbxrefs"), _list(_attr(i, "Ontology_term")).alias("go"), _list(_attr(i, "EC_number")).alias("ec"),
        _list(_attr(i, "Alias")).alias("synonyms"), _attr(i, "gbkey").alias("gbkey"), _attr(i, "Target").alias("target"), "attributes")


def read_gff3(spark: SparkSession, path) -> DataFrame:
    return parse_gff3(lines(spark, path))


def parse_gtf(df: DataFrame) -> DataFrame:
    """Gene and transcript ids and TPM from quoted attributes."""
    p = F.split("value", "\t")
    base = _cells(_data(df), p).where(F.size("p") == 9)
    c = F.col("p")
    a = _col(c, 8)
    get = lambda k: F.nullif(F.regexp_extract(a, rf'(?:^|;)\s*{k} "?([^";]*)"?', 1), F.lit(""))
    return base.select(
        _col(c, 0).alias("contig"), _col(c, 1).alias("source"), _col(c, 2).alias("feature"), _col(c, 3, "long").alias("start"), _col(c, 4, "long").alias("end"),
        _col(c, 6).alias("strand"), get("gene_id").alias("gene_id"), get("transcript_id").alias("tx_id"), get("TPM").try_cast("double").alias("tpm"))


def read_gtf(spark: SparkSession, path) -> DataFrame:
    return parse_gtf(lines(spark, path))


def gtf_gene_ids(features: DataFrame) -> DataFrame:
    """S6."""
    return features.where("gene_id is not null").select("gene_id").distinct()


def parse_bed(df: DataFrame) -> DataFrame:
    """Three or four columns; 0-based starts become 1-based closed spans."""
    p = F.split("value", "\t")
    c = F.col("p")
    return _cells(_data(df), p).where(F.size("p") >= 3).select(
        _col(c, 0).alias("contig"), (_col(c, 1, "long") + 1).alias("start"), _col(c, 2, "long").alias("end"), _col(c, 3).alias("name"))


def read_bed(spark: SparkSession, path) -> DataFrame:
    return parse_bed(lines(spark, path))


def parse_sam(df: DataFrame) -> DataFrame:
    """forward/reverse primary lines that carry both a cs and an NM tag."""
    p = F.split("value", "\t")
    c = F.col("p")
    tags = F.slice(c, 12, F.greatest(F.size(c) - 11, F.lit(0)))
    tag = lambda k: F.get(F.reverse(F.filter(tags, lambda x: x.startswith(k))), F.lit(0))
    rows = _cells(df.where(~F.col("value").startswith("@")), p).where(F.size("p") > 11)
    out = rows.select(_col(c, 0).alias("query"), _col(c, 1, "int").alias("flag"), _col(c, 2).alias("target"), _col(c, 3, "long").alias("pos"),
                      F.length(_col(c, 9)).cast("long").alias("seq_len"), F.regexp_replace(tag("cs:"), "^cs:Z:", "").alias("cs"),
                      F.substring_index(tag("NM:"), ":", -1).try_cast("int").alias("nm"))
    return out.where(F.col("flag").isin(0, 16) & F.col("cs").isNotNull() & F.col("nm").isNotNull())


def read_sam(spark: SparkSession, path) -> DataFrame:
    return parse_sam(lines(spark, path))


def alignment_gff(features: DataFrame) -> DataFrame:
    """Spliced alignments per ID; parts on another contig or strand than the first part drop.

    The first part is the leftmost one on the least (contig, strand), a stable choice.
    """
    rows = features.where("id is not null and target is not null").withColumn("target", F.substring_index("target", " ", 1))
    first = rows.groupBy("id").agg(F.min_by(F.struct("contig", "strand"), F.struct("start", "contig", "strand")).alias("f"))
    return (rows.join(first, "id").where((F.col("contig") == F.col("f.contig")) & (F.col("strand") == F.col("f.strand")))
            .select("id", "target", "contig", "strand", "source", "start", "end", "score"))


def parse_paf(df: DataFrame) -> DataFrame:
    """Twelve columns and the gap-excluded divergence tag."""
    p = F.split("value", "\t")
    c = F.col("p")
    ints = {"qlen", "qstart", "qend", "tlen", "tstart", "tend", "matches", "alnlen", "mapq"}
    de = F.get(F.filter(c, lambda x: x.startswith("de:f:")), F.lit(0))
    return _cells(df, p).where(F.size("p") >= 12).select(
        *[_col(c, i, "long" if n in ints else None).alias(n) for i, n in enumerate(PAF_COLUMNS)], F.substring_index(de, ":", -1).try_cast("double").alias("de"))


def read_paf(spark: SparkSession, path) -> DataFrame:
    return parse_paf(lines(spark, path))


def parse_blast_tab(df: DataFrame, columns: list[str] = BLAST_TAB_14) -> DataFrame:
    """S14."""
    p = F.split("value", "\t")
    c = F.col("p")
    kind = lambda n: None if n.endswith("seqid") else ("double" if n in ("pident", "evalue", "score", "qcovhsp") else "long")
    return _cells(_data(df), p).where(F.size("p") >= len(columns)).select(*[_col(c, i, kind(n)).alias(n) for i, n in enumerate(columns)])


def read_blast_tab(spark: SparkSession, path, columns: list[str] = BLAST_TAB_14) -> DataFrame:
    return parse_blast_tab(lines(spark, path), columns)


def parse_domtblout(df: DataFrame) -> DataFrame:
    """One row per domain hit; many files with headers and footers are just many lines."""
    p = F.split(F.trim("value"), r"\s+", 23)
    c = F.col("p")
    return _cells(_data(df), p).where(F.size("p") >= 22).select(
        _col(c, 0).alias("target"), _col(c, 1).alias("target_acc"), _col(c, 2, "int").alias("target_len"), _col(c, 3).alias("query"), _col(c, 4).alias("query_acc"),
        _col(c, 5, "int").alias("query_len"), _col(c, 6, "double").alias("evalue"), _col(c, 7, "double").alias("score"), _col(c, 9, "int").alias("domain_no"),
        (_col(c, 15, "int") - 1).alias("hmm_start"), _col(c, 16, "int").alias("hmm_end"), (_col(c, 17, "int") - 1).alias("ali_start"), _col(c, 18, "int").alias("ali_end"))


def read_domtblout(spark: SparkSession, path) -> DataFrame:
    return parse_domtblout(lines(spark, path))


def header_of(df: DataFrame, prefix: str) -> str | None:
    row = df.where(F.col("value").startswith(prefix)).select("value").first()
    return row[0] if row else None


def parse_eggnog(df: DataFrame, header: str | None) -> DataFrame:
    """Columns found by header name (any of the layouts), else by position."""
    where = dict(EGGNOG_POSITIONS)
    if header:
        names = [h.lower() for h in header.rstrip().split("\t")]
        layout = 3 if any("max_annot_lvl" in n for n in names) else (2 if any("best_og_name" in n for n in names) else 1)
        where = {}
        for key, text in EGGNOG_LAYOUTS[layout].items():
            found = [i for i, n in enumerate(names) if (n == text if text in ("ec", "ogs", "description") else text in n)]
            where[key] = found[-1] if found else None
    c = F.col("p")
    cell = lambda k: _col(c, where[k]) if where.get(k) is not None else F.lit("")
    return _cells(_data(df), F.split("value", "\t")).select(*[F.coalesce(cell(k), F.lit("")).alias(k) for k in ("query", "ogs", "tax", "symbol", "cogs", "ec", "description")])


def read_eggnog(spark: SparkSession, path) -> DataFrame:
    df = lines(spark, path)
    return parse_eggnog(df, header_of(df, "#query"))


def eggnog_version(df: DataFrame) -> tuple[str | None, str | None]:
    """Version and group prefix from the comment lines."""
    old, new = header_of(df, "# emapper version:"), header_of(df, "## emapper-")
    if new:
        return new.split("## emapper-")[-1], "ENOG50"
    if old:
        return old.split("emapper-")[-1].split()[0], "ENOG41"
    return None, None


def parse_signalp(df: DataFrame, version: int) -> DataFrame:
    """Secreted proteins with the last signal position, cut site and probability."""
    data = _data(df)
    if version < 5:
        c = F.col("p")
        return _cells(data, F.split(F.trim("value"), r"\s+")).where(_col(c, 9) == "Y").select(
            _col(c, 0).alias("id"), (_col(c, 2, "int") - 1).cast("string").alias("end"), F.lit("").alias("cut"), F.lit("").alias("prob"))
    c, k = F.col("p"), F.col("k")
    rows = _cells(data, F.split("value", "\t")).where((F.size("p") >= 5) & (_col(c, 1) != "OTHER"))
    parts = rows.select(_col(c, 0).alias("id"), F.split(F.trim(_col(c, 4)), r"\s+").alias("k"))
    cut = F.replace(_col(k, 3), F.lit("."), F.lit("")) if version == 5 else F.lit("")
    pid = F.substring_index("id", " ", 1) if version >= 6 else F.col("id")
    return parts.select(pid.alias("id"), F.substring_index(_col(k, 2), "-", 1).alias("end"), cut.alias("cut"), F.element_at("k", -1).alias("prob"))


def signalp_version(df: DataFrame) -> int:
    head = header_of(df, "# SignalP-")
    return int(head[len("# SignalP-")]) if head and head[len("# SignalP-")].isdigit() else 4


def read_signalp(spark: SparkSession, path) -> DataFrame:
    df = lines(spark, path)
    return parse_signalp(df, signalp_version(df))


def parse_phobius(df: DataFrame) -> DataFrame:
    """Tab or blank separated short format."""
    c = F.col("p")
    keep = ~F.col("value").startswith("ID") & ~F.col("value").startswith("SEQ") & (F.trim("value") != "")
    return _cells(df.where(keep), F.split(F.trim("value"), r"\s+")).where(F.size("p") >= 4).select(
        _col(c, 0).alias("id"), _col(c, 1, "int").alias("tm"), _col(c, 2).alias("sp"), _col(c, 3).alias("prediction"))


def read_phobius(spark: SparkSession, path) -> DataFrame:
    return parse_phobius(lines(spark, path))


def parse_busco(df: DataFrame, mode: str = "genome") -> DataFrame:
    """Seven genome columns or five protein columns; missing ones stay as null cells."""
    c = F.col("p")
    base = _cells(_data(df), F.split("value", "\t"))
    if mode == "genome":
        return base.select(_col(c, 0).alias("busco"), _col(c, 1).alias("status"), _col(c, 2).alias("contig"), _col(c, 3, "long").alias("start"),
                           _col(c, 4, "long").alias("end"), _col(c, 5, "double").alias("score"), _col(c, 6, "long").alias("length"))
    return base.select(_col(c, 0).alias("busco"), _col(c, 1).alias("status"), _col(c, 2).alias("gene"), _col(c, 3, "double").alias("score"), _col(c, 4, "long").alias("length"))


def read_busco(spark: SparkSession, path, mode: str = "genome") -> DataFrame:
    return parse_busco(lines(spark, path), mode)


def parse_lookup(df: DataFrame, kind: str) -> DataFrame:
    """``(term, description)`` of the small reference tables."""
    c = F.col("p")
    if kind == "merops":
        head = df.where(F.col("value").startswith(">")).select(F.regexp_replace("value", "^>", "").alias("v"))
        return head.select(F.trim(F.substring_index("v", " ", 1)).alias("term"), F.trim(F.substring_index("v", "#", -1)).alias("description"))
    sep, at = {"interpro": ("\t", 2), "pfam": ("\t", 4), "curated": ("\t", 1), "factors": (",", 1), "eggnog": ("\t", 1)}[kind]
    out = _cells(_data(df), F.split("value", sep)).where(F.size("p") > at).select(_col(c, 0).alias("term"), F.trim(_col(c, at)).alias("description"))
    return out


def read_lookup(spark: SparkSession, kind: str, path) -> DataFrame:
    return parse_lookup(lines(spark, path), kind)


def parse_custom_annotations(df: DataFrame) -> DataFrame:
    """Exactly three columns, others are skipped."""
    c = F.col("p")
    return _cells(df, F.split(F.rtrim("value"), "\t")).where(F.size("p") == 3).select(
        _col(c, 0).alias("id"), _col(c, 1).alias("ref_db"), _col(c, 2).alias("value")).where("value != ''")


def read_custom_annotations(spark: SparkSession, path) -> DataFrame:
    return parse_custom_annotations(lines(spark, path))


def parse_abundance(df: DataFrame) -> DataFrame:
    """S34."""
    c = F.col("p")
    data = _data(df).where(~F.col("value").startswith("target_id"))
    return _cells(data, F.split("value", "\t")).where(F.size("p") == 4).select(
        _col(c, 0).alias("tx_id"), _col(c, 1).alias("gene_id"), _col(c, 2).alias("location"), _col(c, 3, "double").alias("tpm"))


def read_abundance(spark: SparkSession, path) -> DataFrame:
    return parse_abundance(lines(spark, path))


def parse_trnascan(df: DataFrame, lo: int = 50, hi: int = 150) -> DataFrame:
    """Table rows of acceptable length; a minus strand is told by swapped ends."""
    c = F.col("p")
    skip = F.col("value").startswith("Sequence") | F.col("value").startswith("Name") | F.col("value").startswith("--------")
    rows = _cells(_data(df).where(~skip), F.split("value", "\t")).where(F.size("p") >= 5).select(
        F.trim(_col(c, 0)).alias("contig"), F.trim(_col(c, 1)).alias("number"), F.trim(_col(c, 2)).cast("long").alias("a"), F.trim(_col(c, 3)).cast("long").alias("b"), F.trim(_col(c, 4)).alias("kind"))
    return rows.where(F.abs(F.col("b") - F.col("a")).between(lo, hi)).select(
        "contig", "number", F.least("a", "b").alias("start"), F.greatest("a", "b").alias("end"), F.when(F.col("a") < F.col("b"), "+").otherwise("-").alias("strand"), "kind")


def read_trnascan(spark: SparkSession, path) -> DataFrame:
    return parse_trnascan(lines(spark, path))


def parse_validation(df: DataFrame, gene_name: str) -> DataFrame:
    """First error reason per gene out of a validation report."""
    err = df.where(F.col("value").startswith("ERROR") & F.col("value").contains(gene_name))
    words = F.filter(F.split(F.trim("value"), " "), lambda w: w.contains(gene_name))
    gene = F.substring_index(F.substring_index(F.element_at(words, -1), "|", -1), "-", 1)
    reason = F.substring_index(F.substring_index(F.col("value"), " FEATURE:", 1), "] ", -1)
    return err.select(gene.alias("gene_id"), reason.alias("reason")).groupBy("gene_id").agg(F.min("reason").alias("reason"))


def read_validation(spark: SparkSession, path, gene_name: str) -> DataFrame:
    return parse_validation(lines(spark, path), gene_name)


def parse_intron_hints(df: DataFrame) -> DataFrame:
    """Hint rows with their multiplicity (1 when it is not given)."""
    mult = F.regexp_extract("attributes", r"mult=(\d+)", 1)
    return parse_gff3(df).where(F.lower("feature") == "intron").select(
        "contig", "start", "end", "strand", F.when(mult != "", mult.cast("long")).otherwise(1).alias("mult"))


def read_intron_hints(spark: SparkSession, path) -> DataFrame:
    return parse_intron_hints(lines(spark, path))


def split_maker(features: DataFrame) -> DataFrame:
    """Route by source to predictions, proteins or transcripts; parts get evidence names."""
    src, part = F.col("source"), F.col("feature").contains("match_part")
    route = (F.when(src.contains("maker"), "prediction").when(src.contains("protein2genome") & part, "protein")
             .when((src.contains("est2genome") | src.contains("cdna2genome") | src.contains("pred_gff")) & part, "transcript"))
    out = features.where(~F.lower("source").contains("trnascan")).withColumn("route", route).where("route is not null")
    name = F.when(F.col("route") == "protein", "nucleotide_to_protein_match").when(F.col("route") == "transcript", "EST_match").otherwise(F.col("feature"))
    score = F.when(src.contains("pred_gff"), 100.0).when(F.col("route") == "prediction", F.col("score"))
    return out.withColumn("feature", name).withColumn("score", score).withColumn("source", F.replace("source", F.lit("pred_gff:"), F.lit("")))


def relabel_lines(df: DataFrame, name: str) -> DataFrame:
    """Text lines of a GFF file under another source; sequence lines and rows without nine columns go."""
    p = F.split("value", "\t")
    row = F.array_join(F.concat(F.slice(p, 1, 1), F.array(F.lit(name)), F.slice(p, 3, 7)), "\t")
    return df.where(~F.col("value").startswith(">") & (F.col("value").startswith("#") | (F.size(p) == 9))).select(
        F.when(F.col("value").startswith("#"), F.col("value")).otherwise(row).alias("value"))


def contigs_of_lines(df: DataFrame) -> DataFrame:
    """Contigs that valid rows name."""
    p = F.split("value", "\t")
    return df.where(~F.col("value").rlike("^[>#]") & (F.size(p) == 9)).select(F.get(p, F.lit(0)).alias("contig")).distinct()


def relabel_source(features: DataFrame, name: str) -> DataFrame:
    """P3."""
    return features.withColumn("source", F.lit(name))


def drop_reported(features: DataFrame, reported: DataFrame) -> DataFrame:
    """P25: rows of reported ids (or children of them) and start/stop codon rows go."""
    bad = reported.select(F.col("id").alias("_bad")).distinct()
    kept = features.where(~F.col("feature").isin("start_codon", "stop_codon"))
    key = F.coalesce(F.get("parents", F.lit(0)), F.col("id"))
    return kept.join(bad, F.col("id") == F.col("_bad"), "left_anti").join(bad, key == F.col("_bad"), "left_anti")
