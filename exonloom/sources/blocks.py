"""Block formats: records that span lines, split by the text reader's separator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scale import computed_once


def read_blocks(spark: SparkSession, path, sep: str) -> DataFrame:
    """One row per block; ``sep`` is the text between two blocks."""
    return spark.read.option("lineSep", sep).text(path)


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """Id, rest of the header, and the joined sequence; gzip works as for any text."""
    blocks = read_blocks(spark, path, "\n>").where(F.trim("value") != "")
    head = F.regexp_replace(F.substring_index("value", "\n", 1), "^>|\r$", "")
    body = F.substring(F.col("value"), F.length(F.substring_index("value", "\n", 1)) + 2, F.length("value"))
    return blocks.select(
        F.substring_index(head, " ", 1).alias("seq_id"),
        F.when(head.contains(" "), F.substring(head, F.length(F.substring_index(head, " ", 1)) + 2, F.length(head))).otherwise("").alias("description"),
        F.regexp_replace(body, r"\s+", "").alias("seq"))


def read_fastq(spark: SparkSession, path) -> DataFrame:
    """Exact four-line records of any file size.

    Lines are numbered inside their file split, split offsets come from a table of
    line counts per split, and a record is line number div 4 of its file.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                       F.monotonically_increasing_id().alias("mid"))
    per = raw.groupBy("file", "block").agg(F.min("mid").alias("lo"), F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window as W
    w = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offs = per.select("file", "block", "lo", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("off"))
    num = raw.join(offs, ["file", "block"]).withColumn("line", F.col("mid") - F.col("lo") + F.col("off"))
    at = lambda k: F.max(F.when(F.col("line") % 4 == k, F.col("value")))
    rec = num.groupBy("file", F.expr("line div 4").alias("rec")).agg(at(0).alias("t"), at(1).alias("seq"), at(3).alias("qual"))
    return rec.where("t like '@%'").select(F.substring("t", F.lit(2), F.length("t")).alias("title"), "seq", "qual")


def fastq_to_fasta(reads: DataFrame) -> DataFrame:
    """Titles with ``/`` turned into ``_``."""
    return reads.select(F.replace("title", F.lit("/"), F.lit("_")).alias("seq_id"), "seq")


def _qualifier(quals: Column, *names: str) -> Column:
    """First value of a qualifier in an array of (key, value)."""
    hits = F.filter(quals, lambda q: q["key"].isin(*names))
    return F.get(hits, F.lit(0))["value"]


def _pairs(text: Column, pattern: str, key: int = 1, value: int = 2) -> Column:
    keys = F.regexp_extract_all(text, F.lit(pattern), F.lit(key))
    vals = F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    return F.zip_with(keys, vals, lambda k, v: F.struct(k.alias("key"), v.alias("value")))


def _coords(text: Column, pattern: str) -> Column:
    """Array of (start, end) from pairs of numbers in either order."""
    a = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    b = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    return F.zip_with(a, b, lambda x, y: F.struct(F.least(x.cast("long"), y.cast("long")).alias("start"), F.greatest(x.cast("long"), y.cast("long")).alias("end")))


def read_tbl(spark: SparkSession, path) -> DataFrame:
    """Features of a submission table: ``contig, gene_no, gene_id, kind, strand, parts`` and qualifiers.

    Contigs split at ``>Feature``, genes and features at their coordinate lines;
    swapped coordinates mean the minus strand.
    """
    blocks = read_blocks(spark, path, "\n>Feature ")
    text = F.regexp_replace("value", "^>Feature ", "")
    contig = F.trim(F.regexp_replace(F.substring_index(text, "\n", 1), r"\s.*$", ""))
    # a row of a generator must not carry the text it is cut from: one contig may be large
    cut = blocks.select(contig.alias("contig"), F.split(text, r"\n(?=[<>]?\d+\t[<>]?\d+\tgene\s)").alias("gs"))
    genes = cut.select("contig", F.posexplode_outer("gs").alias("gene_no", "g")).where("gene_no > 0")
    locus = F.regexp_extract("g", r"(?m)^\t\t\tlocus_tag\t(.*)$", 1)
    cut = genes.select("contig", "gene_no", locus.alias("gene_id"), F.split("g", r"\n(?=[<>]?\d+\t[<>]?\d+\t\w)").alias("fs"))
    feats = cut.select("contig", "gene_no", "gene_id", F.posexplode_outer("fs").alias("feat_no", "f"))
    kind = F.regexp_extract("f", r"^[<>]?\d+\t[<>]?\d+\t(\w+)", 1)
    first = F.regexp_extract("f", r"^[<>]?(\d+)\t[<>]?(\d+)", 1).cast("long")
    second = F.regexp_extract("f", r"^[<>]?(\d+)\t[<>]?(\d+)", 2).cast("long")
    quals = _pairs(F.col("f"), r"(?m)^\t\t\t(\w+)(?:\t(.*))?$")
    rows = feats.select("contig", F.col("gene_no").cast("long").alias("gene_no"), "gene_id", F.col("feat_no").cast("long").alias("feat_no"), kind.alias("kind"),
                        F.when(first <= second, "+").otherwise("-").alias("strand"), F.array_sort(_coords(F.col("f"), r"(?m)^[<>]?(\d+)\t[<>]?(\d+)")).alias("parts"),
                        F.col("f").rlike(r"(?m)^<").alias("partial_start"), F.col("f").rlike(r"(?m)^[<>]?\d+\t>").alias("partial_stop"), quals.alias("quals"))
    q = F.col("quals")
    clean = lambda c: F.regexp_replace(F.substring_index(c, "|", -1), "_mrna$", "")
    return rows.select("contig", "gene_no", "gene_id", "feat_no", "kind", "strand", "parts", "partial_start", "partial_stop", _qualifier(q, "product").alias("product"),
                       clean(_qualifier(q, "transcript_id")).alias("tx_id"), clean(_qualifier(q, "protein_id")).alias("protein_id"),
                       _qualifier(q, "codon_start").cast("int").alias("codon_start"), "quals")


def read_genbank(spark: SparkSession, path) -> DataFrame:
    """One row per record: id, metadata, raw features and sequence."""
    rec = read_blocks(spark, path, "\n//\n").where(F.col("value").contains("LOCUS"))
    v = F.col("value")
    one = lambda pat: F.nullif(F.trim(F.regexp_extract(v, pat, 1)), F.lit(""))
    # the end of the table is found by plain searches; a pattern would be tried at every letter of it
    rest = F.get(F.split(v, "\nFEATURES[^\n]*\n", 2), F.lit(1))
    ended = F.substring_index(F.substring_index(rest, "\nORIGIN", 1), "\nCONTIG", 1)
    table = F.when(rest.contains("\nORIGIN") | rest.contains("\nCONTIG"), ended).otherwise(F.regexp_extract(v, r"(?s)\nFEATURES[^\n]*\n(.*?)(?=\nORIGIN|\nCONTIG|$)", 1))
    origin = F.regexp_extract(v, r"(?s)\nORIGIN[^\n]*\n(.*)$", 1)
    version = one(r"(?m)^VERSION\s+(\S+)")
    return rec.select(
        F.coalesce(version, one(r"(?m)^ACCESSION\s+(\S+)"), one(r"(?m)^LOCUS\s+(\S+)")).alias("record"), one(r"(?m)^ACCESSION\s+(\S+)").alias("accession"),
        F.regexp_extract(v, r"(?m)^VERSION\s+\S+\.(\d+)", 1).try_cast("int").alias("version"), F.trim(F.replace(one(r"(?m)^  ORGANISM\s+(.*)$"), F.lit("Unclassified."), F.lit(""))).alias("organism"),
        F.upper(F.regexp_replace(origin, "[^A-Za-z]", "")).alias("seq"), table.alias("table"),
        one(r"(?m)^CONTIG\s+join\(([A-Z]{4})").alias("wgs"), F.regexp_extract(v, r"(?m)^\s+Version\s+::\s+(\d+)", 1).try_cast("int").alias("smash_version"))


def genbank_features(records: DataFrame) -> DataFrame:
    """Features with parts, strand, and qualifiers; ids by the usual fallback chain."""
    feats = records.select("record", F.posexplode_outer(F.split(F.regexp_replace("table", "^ {5}", ""), r"\n {5}(?=\S)")).alias("feat_no", "f"))
    kind = F.regexp_extract("f", r"^(\S+)", 1)
    loc = F.regexp_replace(F.regexp_extract("f", r"(?s)^\S+\s+(.*?)(?=\n {21}/|$)", 1), r"\s", "")
    body = F.regexp_extract("f", r"(?s)\n {21}(/.*)$", 1)
    items = F.filter(F.split(F.regexp_replace(body, "^/", ""), r"\n {21}/"), lambda x: x != "")
    def one(x):
        val = F.substring(x, F.instr(x, "=") + 1, F.length(x))
        key = F.substring_index(x, "=", 1)
        glue = F.when(key == "translation", F.lit("")).otherwise(F.lit(" "))
        text = F.regexp_replace(F.regexp_replace(val, r'^"|"$', ""), F.lit(r"\n {21}"), glue)
        return F.struct(key.alias("key"), F.when(x.contains("="), text).otherwise("").alias("value"))
    # qualifiers are read once a feature, and not at all for kinds that the caller leaves out
    rows = feats.where("f != ''").select("record", F.col("feat_no").cast("long").alias("feat_no"), kind.alias("kind"), "f")
    rows = computed_once(rows, "quals", F.transform(items, one)).select("record", "feat_no", "kind", loc.alias("loc"), "quals")
    q = F.col("quals")
    tag = F.coalesce(_qualifier(q, "locus_tag"), _qualifier(q, "gene"), F.when(F.col("kind") != "gene", F.coalesce(_qualifier(q, "transcript_id"), _qualifier(q, "protein_id"))))
    tid = F.when(F.col("kind") == "gene", F.when(_qualifier(q, "locus_tag").isNotNull(), _qualifier(q, "gene"))).when(
        F.col("kind") == "CDS", F.coalesce(_qualifier(q, "protein_id"), _qualifier(q, "standard_name"))).otherwise(F.coalesce(_qualifier(q, "transcript_id"), _qualifier(q, "standard_name")))
    parts = F.regexp_replace("loc", r"(?<![\d.<>])([<>]?\d+)(?![\d.]|\.\.)", "$1..$1")
    return rows.select("record", "feat_no", "kind", tag.alias("locus_tag"), F.substring_index(tid, ":", -1).alias("id"),
                       F.when(F.col("loc").startswith("complement"), "-").otherwise("+").alias("strand"),
                       F.array_sort(_coords(parts, r"[<>]?(\d+)\.\.[<>]?(\d+)")).alias("parts"), F.col("loc").contains("<").alias("open_left"), F.col("loc").contains(">").alias("open_right"),
                       _qualifier(q, "product").alias("product"), _qualifier(q, "codon_start").cast("int").alias("codon_start"), _qualifier(q, "translation").alias("translation"), "quals")


def genbank_metadata(records: DataFrame) -> DataFrame:
    """Organism, strain, isolate, accession, WGS prefix and version of the first record."""
    q = lambda k: F.nullif(F.regexp_extract("table", rf'/{k}="([^"]*)"', 1), F.lit(""))
    return records.orderBy("record").limit(1).select("organism", q("strain").alias("strain"), q("isolate").alias("isolate"), "accession",
                                                     F.concat(F.lit("WGS:"), "wgs").alias("wgs_accession"), "version")


def antismash_clusters(records: DataFrame) -> DataFrame:
    """Cluster regions; names follow the report version (4, 5, or later)."""
    f = genbank_features(records).join(records.select("record", F.coalesce("smash_version", F.lit(4)).alias("ver")), "record")
    old = (F.col("ver") == 4) & (F.col("kind") == "cluster")
    new = (F.col("ver") >= 5) & (F.col("kind") == "protocluster")
    q = F.col("quals")
    number = F.when(old, F.replace(_qualifier(q, "note"), F.lit("Cluster number: "), F.lit(""))).otherwise(_qualifier(q, "protocluster_number"))
    digits = F.regexp_extract(F.regexp_replace("record", r"\.\d+$", ""), r"(\d+)$", 1).cast("long").cast("string")
    name = F.when(F.col("ver") == 5, F.concat(F.lit("Cluster_"), digits, F.lit("."), number)).otherwise(F.concat(F.lit("Cluster_"), number))
    return f.where(old | new).select(F.col("record").alias("contig"), F.array_min(F.transform("parts", lambda p: p["start"])).alias("start"),
                                     F.array_max(F.transform("parts", lambda p: p["end"])).alias("end"), name.alias("name"))


def antismash_genes(records: DataFrame) -> DataFrame:
    """Backbone class, subtype, domains and smCOG per gene."""
    f = genbank_features(records)
    cds = f.where((F.col("kind") == "CDS") & F.coalesce("id", "locus_tag").isNotNull())
    q = F.col("quals")
    vals = lambda k: F.transform(F.filter(q, lambda x: x["key"] == k), lambda x: x["value"])
    sec = F.concat(vals("sec_met"), vals("NRPS_PKS"))
    strip = lambda pat: F.get(F.transform(F.filter(sec, lambda x: x.rlike(pat)), lambda x: F.regexp_replace(x, F.lit(pat + " ?"), F.lit(""))), F.lit(0))
    doms = F.transform(F.filter(sec, lambda x: x.rlike("^(NRPS/PKS )?Domain:")), lambda x: F.substring_index(F.regexp_replace(x, F.lit("^(NRPS/PKS )?Domain: "), F.lit("")), ". ", 1))
    cog4 = F.get(F.transform(F.filter(vals("note"), lambda x: x.startswith("smCOG:")), lambda x: F.substring_index(F.replace(x, F.lit("smCOG: "), F.lit("")), " (", 1)), F.lit(0))
    cog5 = F.get(F.transform(F.filter(vals("gene_functions"), lambda x: x.contains("(smcogs)")), lambda x: F.substring_index(F.trim(F.substring_index(x, "(smcogs)", -1)), " (", 1)), F.lit(0))
    return cds.select(F.replace(F.coalesce("id", "locus_tag"), F.lit("ncbi_"), F.lit("")).alias("gene_id"), strip("^(Type|type):").alias("backbone"),
                      strip("^NRPS[/_]PKS subtype:").alias("subtype"), F.array_join(doms, ";").alias("domains"), F.coalesce(cog4, cog5).alias("smcog"))


def read_obo(spark: SparkSession, path) -> DataFrame:
    """Ontology terms with alternative ids and parents."""
    b = read_blocks(spark, path, "\n[Term]\n").where("value like 'id:%'")
    one = lambda k: F.regexp_extract("value", rf"(?m)^{k}: (.*)$", 1)
    many = lambda pat: F.regexp_extract_all("value", F.lit(pat), F.lit(1))
    return b.select(one("id").alias("go_id"), one("name").alias("name"), one("namespace").alias("namespace"), many(r"(?m)^alt_id: (\S+)").alias("alt_ids"), many(r"(?m)^is_a: (\S+)").alias("parents"))


def read_zff(spark: SparkSession, path) -> DataFrame:
    """Exon parts per predicted model; ids in order of the model number."""
    b = read_blocks(spark, path, "\n>").withColumn("value", F.regexp_replace("value", "^>", ""))
    contig = F.trim(F.substring_index("value", "\n", 1))
    rows = b.select(contig.alias("contig"), F.explode_outer(F.split("value", "\n")).alias("l"))
    p = F.split(F.trim("l"), r"\s+")
    c = F.col("p")
    return rows.select("contig", p.alias("p")).where(F.size("p") >= 9).select(
        "contig", F.get(c, F.lit(0)).alias("label"), F.least(F.get(c, F.lit(1)).cast("long"), F.get(c, F.lit(2)).cast("long")).alias("start"),
        F.greatest(F.get(c, F.lit(1)).cast("long"), F.get(c, F.lit(2)).cast("long")).alias("end"), F.get(c, F.lit(3)).alias("strand"),
        F.get(c, F.lit(4)).try_cast("double").alias("score"), F.get(c, F.lit(8)).alias("tx_id"))


def read_exonerate(spark: SparkSession, path, mode: str = "prot") -> DataFrame:
    """One row per aligned exon with its target range (protein lengths are thirds)."""
    b = read_blocks(spark, path, "##gff-version").where(F.col("value").contains("\tsimilarity\t") | F.col("value").contains("similarity"))
    exon = r"(?m)^(\S+)\s+\S+\s+exon\s+(\d+)\s+(\d+)\s+\S+\s+(\S)"
    grab = lambda g: F.regexp_extract_all("value", F.lit(exon), F.lit(g))
    pos = F.regexp_extract_all("value", F.lit(r"Align \d+ (\d+) (\d+)"), F.lit(1))
    ln = F.regexp_extract_all("value", F.lit(r"Align \d+ (\d+) (\d+)"), F.lit(2))
    target = F.regexp_extract("value", r"(?m)\sgene\s.*sequence (\S+)", 1)
    pid = F.regexp_extract("value", r"AveragePercentIdentity:\s*(\S+)", 1)
    rows = b.select(target.alias("target"), pid.alias("per_id"), pos.alias("pos"), ln.alias("len"), grab(1).alias("ctg"), grab(4).alias("st"),
                    F.posexplode_outer(F.arrays_zip(grab(2).alias("a"), grab(3).alias("b"))).alias("i", "e")).where("e is not null")
    rel = F.coalesce(F.get("pos", F.col("i")).cast("long"), F.lit(0).cast("long"))
    rlen = F.coalesce(F.get("len", F.col("i")).cast("long"), F.lit(0).cast("long"))
    step = F.floor(rlen / 3) if mode == "prot" else rlen
    return rows.select(F.get("ctg", F.col("i")).alias("contig"), F.least(F.col("e.a").cast("long"), F.col("e.b").cast("long")).alias("start"),
                       F.greatest(F.col("e.a").cast("long"), F.col("e.b").cast("long")).alias("end"), F.get("st", F.col("i")).alias("strand"),
                       F.col("per_id").try_cast("double").alias("score"), "target", (F.col("i") + 1).alias("part"), rel.alias("t_start"), (rel + step).alias("t_end"))


def read_augustus_support(spark: SparkSession, path, introns_only: bool = False) -> DataFrame:
    """Hint support in percent per gene block."""
    b = read_blocks(spark, path, "# start gene ").where("value != '' and value not like '#%'")
    gene = F.trim(F.substring_index("value", "\n", 1))
    if introns_only:
        a = F.regexp_extract("value", r"# CDS introns: (\d+)/(\d+)", 1).try_cast("double")
        n = F.regexp_extract("value", r"# CDS introns: (\d+)/(\d+)", 2).try_cast("double")
        sup = F.when(n > 0, a / n * 100).otherwise(F.lit(0.0))
    else:
        sup = F.regexp_extract("value", r"# % of transcript supported by hints \(any source\): (\S+)", 1).try_cast("double")
    return b.select(gene.alias("gene_id"), sup.alias("support"))


def read_discrepancies(spark: SparkSession, path) -> DataFrame:
    """Gene rows of a discrepancy report with the section they stand in."""
    b = read_blocks(spark, path, "\nDiscRep_").withColumn("value", F.regexp_replace("value", "^DiscRep_", ""))
    sec = F.regexp_extract("value", r"^(\w+:\w+)::", 1)
    reason = F.regexp_extract("value", r"^\w+:\w+::(.*)", 1)
    rows = b.where(sec != "").select(sec.alias("section"), F.trim(reason).alias("reason"), F.explode_outer(F.regexp_extract_all("value", F.lit(r"(?m)^genome:(.*)$"), F.lit(1))).alias("item")).where("item is not null")
    return rows.select("section", "reason", F.col("item").startswith("tRNA").alias("is_trna"), F.trim(F.substring_index("item", "\t", -1)).alias("gene_id"))
