"""XML formats through Spark's XML reader with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLAST_SCHEMA = """`Iteration_query-def` string, `Iteration_query-len` int,
 Iteration_hits struct<Hit: array<struct<Hit_num: int, Hit_id: string, Hit_def: string, Hit_accession: string, Hit_len: int,
  Hit_hsps: struct<Hsp: array<struct<Hsp_num: int, `Hsp_bit-score`: double, Hsp_evalue: double, `Hsp_query-from`: int, `Hsp_query-to`: int,
   `Hsp_hit-from`: int, `Hsp_hit-to`: int, Hsp_identity: int, `Hsp_align-len`: int>>>>>>"""

_ENTRY = "struct<entry: struct<_ac: string, `go-xref`: array<struct<_id: string, _category: string, _name: string>>>>"
# Match elements of the domain-search report.
MATCH_KINDS = ["hmmer3-match", "hmmer2-match", "profilescan-match", "rpsblast-match", "superfamilyhmmer3-match", "panther-match",
               "fingerprints-match", "patternscan-match", "blastprodom-match", "coils-match", "mobidblite-match", "hmmer3-match-with-sites"]
IPR_SCHEMA = "sequence string, xref array<struct<_id: string, _name: string>>, matches struct<" + ", ".join(
    f"`{k}`: array<struct<signature: {_ENTRY}>>" for k in MATCH_KINDS) + ">"


def read_blast_xml(spark: SparkSession, path) -> DataFrame:
    """First hit and first HSP of every query."""
    it = spark.read.format("xml").option("rowTag", "Iteration").schema(BLAST_SCHEMA).load(path)
    hit = F.get("Iteration_hits.Hit", F.lit(0))
    base = it.select(F.substring_index("Iteration_query-def", " ", 1).alias("query"), F.col("`Iteration_query-len`").alias("qlen"), hit.alias("h")).where("h is not null")
    hsp = F.get("h.Hit_hsps.Hsp", F.lit(0))
    base = base.select("query", "qlen", "h.Hit_id", "h.Hit_def", F.col("h.Hit_len").alias("slen"), hsp.alias("p"))
    return base.select("query", F.col("Hit_id").alias("subject"), F.col("Hit_def").alias("description"), "qlen", "slen",
                       F.col("p.`Hsp_query-from`").alias("qstart"), F.col("p.`Hsp_query-to`").alias("qend"), F.col("p.`Hsp_hit-from`").alias("sstart"), F.col("p.`Hsp_hit-to`").alias("send"),
                       F.col("p.Hsp_identity").alias("n_ident"), F.col("p.`Hsp_align-len`").alias("aln_len"), F.col("p.Hsp_evalue").alias("evalue"), F.col("p.`Hsp_bit-score`").alias("bitscore"))


def read_interproscan_xml(spark: SparkSession, path) -> DataFrame:
    """``(id, kind, term, category, name)``, distinct per protein; a glob merges many files."""
    p = spark.read.format("xml").option("rowTag", "protein").option("ignoreNamespace", "true").schema(IPR_SCHEMA).load(path)
    empty = F.array().cast("array<" + _ENTRY + ">")
    sigs = F.concat(*[F.coalesce(F.transform(F.col(f"matches.`{k}`"), lambda m: m["signature"]), empty) for k in MATCH_KINDS])
    rows = p.select(F.transform("xref", lambda x: x["_id"]).alias("ids"), F.transform(sigs, lambda s: s["entry"]).alias("entries"))
    ents = rows.select(F.explode_outer("ids").alias("id"), F.explode_outer("entries").alias("e")).where("e is not null and id is not null")
    ipr = ents.where("e._ac is not null").select("id", F.lit("InterPro").alias("kind"), F.col("e._ac").alias("term"), F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("name"))
    go = ents.select("id", F.explode_outer("e.`go-xref`").alias("g")).where("g is not null").select("id", F.lit("GO").alias("kind"), F.col("g._id").alias("term"), F.lower(F.replace(F.col("g._category"), F.lit("_"), F.lit(" "))).alias("category"), F.col("g._name").alias("name"))
    return ipr.unionByName(go).distinct()


def interproscan_annotations(rows: DataFrame) -> DataFrame:
    """Annotation triples for InterPro ids and GO terms."""
    kind = F.when(F.col("category").contains("process"), "go_process").when(F.col("category").contains("function"), "go_function").when(F.col("category").contains("component"), "go_component")
    ipr = rows.where("kind = 'InterPro'").select("id", F.lit("db_xref").alias("ref_db"), F.concat(F.lit("InterPro:"), "term").alias("value"))
    go = rows.where("kind = 'GO' and category is not null and name is not null").select("id", kind.alias("ref_db"), F.concat("name", F.lit("|"), F.replace("term", F.lit("GO:"), F.lit("")), F.lit("||IEA")).alias("value"))
    return ipr.unionByName(go)


def read_interpro_entries(spark: SparkSession, path, terms: DataFrame) -> DataFrame:
    """Names of the wanted entries only."""
    x = spark.read.format("xml").option("rowTag", "interpro").schema("_id string, name string").load(path)
    return x.select(F.col("_id").alias("term"), F.col("name").alias("description")).join(terms.select("term").distinct(), "term", "left_semi")
