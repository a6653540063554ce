"""Annotation-shaped views over the given tables, once for Spark and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import spread
from .registry import Tables

IV = """iv as (select 'ctg' || l_suppkey as contig, l_partkey as "start",
  l_partkey + cast(l_quantity as bigint) as "end",
  case when l_linestatus = 'O' then '+' else '-' end as strand,
  l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey as name,
  l_returnflag as source, l_extendedprice as score from lineitem)"""

MASK = """mask as (select 'ctg' || (p_partkey % (select count(*) from supplier)) as contig,
  p_partkey as "start", p_partkey + p_size as "end", p_name || p_partkey as name from part)"""

TX = """tx as (select l_orderkey as gene_id, l_linenumber as tx_no,
  l_partkey * 10 as "start", l_partkey * 10 + cast(l_quantity as bigint) as "end", count(*) as copies
  from lineitem group by 1, 2, 3, 4)"""

HITS = """hits as (select l_partkey as query, l_suppkey as subject, l_discount as evalue,
  l_extendedprice as bitscore, l_quantity as pident, l_orderkey as hit_id, l_linenumber as hit_no,
  l_tax as tax, l_returnflag as flag from lineitem)"""

ANNOTS = """annots as (select 'GENE_' || printf('%05d', user_id) || '-T' || (event_id % 2 + 1) as id,
  case event_type when 'signup' then 'name' when 'purchase' then 'product' when 'click' then 'db_xref'
    when 'view' then 'note' else 'EC_number' end as ref_db,
  regexp_extract(props, '([0-9]+)', 1) as value, event_id from events)"""

FAM = """fam as (select n_name as species, p_brand as family, p_type as class, l_quantity as qty
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  join part on l_partkey = p_partkey)"""

ORTH = """orth as (select distinct p_type || '_' || p_size as group_id, n_name as species, 'g' || l_partkey as gene_id
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  join part on l_partkey = p_partkey)"""

SEQS = """seqs as (select 'seq' || doc_id as seq_id, lang as genome, source as description,
  regexp_replace(text, '[^ACGTNacgtn]', '', 'g') as seq from documents)"""

# readable nucleotides: letters of the text folded onto the four bases
DNA = """dna as (select 'seq' || doc_id as seq_id, doc_id,
  translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') as seq
  from documents)"""


def iv(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("ctg"), "l_suppkey").alias("contig"), F.col("l_partkey").alias("start"),
        (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("end"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("name"),
        F.col("l_returnflag").alias("source"), F.col("l_extendedprice").alias("score"))


def mask(t: Tables) -> DataFrame:
    n = t.supplier.select(F.count(F.lit(1))).scalar()
    return t.part.select(
        F.concat(F.lit("ctg"), F.col("p_partkey") % n).alias("contig"), F.col("p_partkey").alias("start"),
        (F.col("p_partkey") + F.col("p_size")).alias("end"), F.concat("p_name", "p_partkey").alias("name"))


def tx(t: Tables) -> DataFrame:
    return (t.lineitem.groupBy(
        F.col("l_orderkey").alias("gene_id"), F.col("l_linenumber").alias("tx_no"),
        (F.col("l_partkey") * 10).alias("start"),
        (F.col("l_partkey") * 10 + F.col("l_quantity").cast("long")).alias("end"))
        .agg(F.count(F.lit(1)).alias("copies")))


def hits(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("query"), F.col("l_suppkey").alias("subject"), F.col("l_discount").alias("evalue"),
        F.col("l_extendedprice").alias("bitscore"), F.col("l_quantity").alias("pident"),
        F.col("l_orderkey").alias("hit_id"), F.col("l_linenumber").alias("hit_no"), F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("flag"))


def annots(t: Tables) -> DataFrame:
    kinds = F.create_map(*[F.lit(x) for x in (
        "signup", "name", "purchase", "product", "click", "db_xref", "view", "note", "error", "EC_number")])
    return t.events.select(
        F.concat(F.lit("GENE_"), F.format_string("%05d", F.col("user_id")), F.lit("-T"),
                 F.col("event_id") % 2 + 1).alias("id"),
        kinds[F.col("event_type")].alias("ref_db"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("value"), "event_id")


def fam(t: Tables) -> DataFrame:
    return (t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("n_name").alias("species"), F.col("p_brand").alias("family"),
                    F.col("p_type").alias("class"), F.col("l_quantity").alias("qty")))


def orth(t: Tables) -> DataFrame:
    return (t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.concat_ws("_", "p_type", "p_size").alias("group_id"), F.col("n_name").alias("species"),
                    F.concat(F.lit("g"), "l_partkey").alias("gene_id")).distinct())


def seqs(t: Tables) -> DataFrame:
    return spread(t.documents.select("doc_id", "lang", "source", "text")).select(
        F.concat(F.lit("seq"), "doc_id").alias("seq_id"), F.col("lang").alias("genome"),
        F.col("source").alias("description"), F.regexp_replace("text", "[^ACGTNacgtn]", "").alias("seq"))


def dna(t: Tables) -> DataFrame:
    return spread(t.documents.select("doc_id", "text")).select(
        F.concat(F.lit("seq"), "doc_id").alias("seq_id"), "doc_id",
        F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), "abcdefghijklmnopqrstuvwxyz",
                    "ACGTACGTACGTACGTACGTACGTAC").alias("seq"))
