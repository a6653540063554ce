"""Registered reader queries: files are written from the tables by Spark and read back."""

from pyspark.sql import functions as F

from ..functions import alignment as AL
from ..operators import models as M
from ..operators import sequences as Q
from ..scale import scratch_path, spread
from ..sinks import text as K
from ..sources import blocks as B
from ..sources import lines as L
from ..sources import pieces as FP
from ..sources import predictors as P
from ..sources import xml as X
from . import views as V
from .q_models import GM, gene_table
from .q_sequence import run_sql
from .registry import query


def saved(df, column="value"):
    """Writes one text column (one record per row) and returns the folder; text is packed, as it repeats itself a lot."""
    path = scratch_path(df.sparkSession, "text")
    df.select(F.col(column).alias("value")).write.option("compression", "lz4").text(path)
    return path


def saved_xml(df, root):
    """Writes record elements under one root element per file."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.pmod(F.xxhash64("value"), F.lit(n)).alias("bucket"), F.lit(1).alias("ord"), "value")
    ends = rows.select("bucket").distinct().select("bucket", F.explode_outer(F.array(
        F.struct(F.lit(0).alias("ord"), F.lit(f"<{root}>").alias("value")), F.struct(F.lit(2).alias("ord"), F.lit(f"</{root}>").alias("value")))).alias("x")).select("bucket", "x.*")
    path = scratch_path(spark, "xml")
    rows.unionByName(ends).repartition("bucket").sortWithinPartitions("bucket", "ord").select("bucket", "value").write.partitionBy("bucket").text(path)
    return path


def tab(*cols):
    return F.concat_ws("\t", *[c if not isinstance(c, str) else F.lit(c) for c in cols])


C = F.col


@query("s1_read_fasta", f"with {V.SEQS} select seq_id, description, seq from seqs")
def _(t):
    s = V.seqs(t).select(F.concat("seq_id", F.lit(" "), "description").alias("h"), "seq")
    return B.read_fasta(t.spark, saved(K.fasta_lines(s, header="h"), "line"))


def fasta_pieces(t, size):
    """The sequences written as wrapped FASTA, read back in pieces."""
    path = scratch_path(t.spark, "fasta")
    K.write_fasta_blocks(V.seqs(t), path)
    return FP.read_fasta_pieces(t.spark, path, size)


@query("s1_fasta_pieces", f"""with {V.SEQS} select seq_id, i as piece, i * 1000 as "offset", substr(seq, i * 1000 + 1, 1000) as chunk from (select *, unnest(range(0, greatest(1, (length(seq) + 999) // 1000))) as i from seqs)""")
def _(t):
    return fasta_pieces(t, 1000).select("seq_id", "piece", "offset", "chunk")


@query("f9_split_pieces_at_gaps", f"""with {V.SEQS}, {run_sql('seqs', 'Nn', 2)}, lens as (select seq_id, length(seq) as n from seqs where length(seq) > 0),
 mk as (select seq_id, "start", "end" from r union all select seq_id, n + 1, n + 1 from lens),
 ct as (select seq_id, coalesce(lag("end") over (partition by seq_id order by "start"), 0) + 1 as "start", "start" - 1 as "end" from mk),
 parts as (select seq_id, "start", "end", 'N' as kind from r union all select seq_id, "start", "end", 'W' from ct where "start" <= "end")
 select seq_id, "start", "end", kind, row_number() over (partition by seq_id order by "start") as part from parts""")
def _(t):
    return Q.split_at_gaps(fasta_pieces(t, Q.PIECE), min_n=2)


@query("k20_piece_files", f"with {V.SEQS} select seq_id, length(seq) as n, md5(seq) as digest from seqs")
def _(t):
    path = scratch_path(t.spark, "contigs")
    K.write_partitioned(fasta_pieces(t, Q.PIECE), path, size=4000)
    return B.read_fasta(t.spark, path).select("seq_id", F.length("seq").cast("long").alias("n"), F.md5(F.col("seq").cast("binary")).alias("digest"))


@query("s2_read_fastq", """select 'r' || l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey || '/1' as title, repeat('ACG', cast(l_quantity as int)) as seq, '@' || repeat('I', cast(l_quantity as int) * 3 - 1) as qual from lineitem""")
def _(t):
    q = C("l_quantity").cast("int")
    title = F.concat(F.lit("r"), F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.lit("/1"))
    rec = F.concat_ws("\n", F.concat(F.lit("@"), title), F.repeat(F.lit("ACG"), q), F.lit("+"), F.concat(F.lit("@"), F.repeat(F.lit("I"), q * 3 - 1)))
    return B.read_fastq(t.spark, saved(t.lineitem.select(rec.alias("value"))))


@query("s2_fastq_to_fasta", """select 'r' || p_partkey || '_2' as seq_id, repeat('AC', p_size) as seq from part""")
def _(t):
    rec = F.concat_ws("\n", F.concat(F.lit("@r"), "p_partkey", F.lit("/2")), F.repeat(F.lit("AC"), C("p_size")), F.lit("+"), F.repeat(F.lit("#"), C("p_size") * 2))
    return B.fastq_to_fasta(B.read_fastq(t.spark, saved(t.part.select(rec.alias("value")))))


def gtf_text(t):
    g = gene_table(t)
    at = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; transcript_id "'), "tx_id", F.lit('"; '))
    tx = g.select(tab(C("contig"), "StringTie", "transcript", C("gene_start"), C("gene_end"), "1000", C("strand"), ".", F.concat(at, F.lit('TPM "'), "tpm", F.lit('";'))).alias("value"))
    ex = g.select("contig", "strand", at.alias("at"), F.explode_outer("exons").alias("e")).select(
        tab(C("contig"), "StringTie", "exon", C("e.start"), C("e.end"), "1000", C("strand"), ".", C("at")).alias("value"))
    return tx.unionByName(ex)


@query("s5_gtf_models", f"""with {GM} select gene_id, tx_id, contig, strand, cast(t as double) as tpm, string_agg(s || '-' || e, ',' order by s) as exons, g0 as gene_start, g1 as gene_end from gm group by all""")
def _(t):
    m = M.gtf_models(L.parse_gtf(gtf_text(t)))
    return m.select("gene_id", "tx_id", "contig", "strand", "tpm", F.array_join(F.transform("exons", lambda e: F.concat(e["start"], F.lit("-"), e["end"])), ",").alias("exons"), "gene_start", "gene_end")


@query("s6_gtf_gene_ids", f"with {GM} select distinct gene_id from gm")
def _(t):
    return L.gtf_gene_ids(L.parse_gtf(gtf_text(t)))


@query("s7_read_tbl", f"""with {GM}, x as (select *, case when g % 5 = 0 and (select count(*) from sp where sp.g = gm.g) > 1 then case when t = 2 then 1 else 2 end else 1 end as rk from gm)
 select contig, gene_id, 'mRNA' as kind, strand, gene_id || '-T' || rk as tx_id, 'prod ' || (g % 9) as product, string_agg(s || '-' || e, ',' order by s) as parts, g % 7 = 0 as partial_stop from x group by contig, gene_id, strand, g, rk
 union all select contig, gene_id, 'CDS', strand, gene_id || '-T' || rk, 'prod ' || (g % 9), string_agg(cs || '-' || ce, ',' order by cs), g % 7 = 0 from x group by contig, gene_id, strand, g, rk
 union all select distinct contig, gene_id, 'gene', strand, null, null, g0 || '-' || g1, g % 7 = 0 from gm""")
def _(t):
    m = M.order_transcripts(gene_table(t))
    seqs = m.select(F.col("contig").alias("seq_id")).distinct().withColumn("seq", F.lit("ACGT"))
    path = scratch_path(t.spark, "tbl")
    K.write_tbl(m, seqs, path)
    f = B.read_tbl(t.spark, path)
    return f.select("contig", "gene_id", "kind", "strand", "tx_id", "product", F.array_join(F.transform("parts", lambda e: F.concat(e["start"], F.lit("-"), e["end"])), ",").alias("parts"), "partial_stop")


def genbank_text(t):
    g = gene_table(t)
    pad = F.lit(" " * 21)
    wrap = lambda c: F.when(C("strand") == "-", F.concat(F.lit("complement("), c, F.lit(")"))).otherwise(c)
    rng = lambda a: F.array_join(F.transform(a, lambda e: F.concat(e["start"], F.lit(".."), e["end"])), ",\n" + " " * 21)
    joined = lambda a: F.when(F.size(a) > 1, F.concat(F.lit("join("), rng(a), F.lit(")"))).otherwise(rng(a))
    q = lambda k, v: F.concat(pad, F.lit(f'/{k}="'), v, F.lit('"'))
    feat = lambda kind, loc: F.concat(F.lit("     "), F.rpad(F.lit(kind), 16, " "), loc)
    lines = F.concat_ws("\n",
        F.concat(F.lit("LOCUS       "), "tx_id", F.lit(" 100 bp DNA linear PLN")), F.concat(F.lit("ACCESSION   "), "tx_id"), F.concat(F.lit("VERSION     "), "tx_id", F.lit(".2")),
        F.lit("SOURCE      x\n  ORGANISM  Genus species"), F.lit("FEATURES             Location/Qualifiers"),
        feat("source", F.lit("1..100")), q("isolate", F.lit("iso1")),
        feat("gene", wrap(F.concat("gene_start", F.lit(".."), "gene_end"))), q("locus_tag", C("gene_id")),
        feat("CDS", wrap(joined(C("cds")))), q("locus_tag", C("gene_id")), q("protein_id", F.concat(F.lit("ncbi:"), "tx_id")), q("product", F.concat(F.lit("long\n" + " " * 21), "product")),
        F.concat(pad, F.lit("/codon_start=1")), q("translation", F.lit("MKV\n" + " " * 21 + "LLA")), F.concat(pad, F.lit('/NRPS_PKS="type: t1pks"')), F.concat(pad, F.lit('/NRPS_PKS="Domain: KS. x"')), F.concat(pad, F.lit('/gene_functions="b (smcogs) SMCOG1001: reg (Score: 1)"')),
        feat("protocluster", F.concat("gene_start", F.lit(".."), "gene_end")), q("protocluster_number", F.lit("1")),
        F.lit("ORIGIN\n        1 acgtacgtac gtacgtacgt\n       21 nnnn"), F.lit("//"))
    return saved(g.select(lines.alias("value")))


GB1 = f"with {GM}, one as (select * from gm)"


@query("s8_genbank_features", f"""{GB1} select tx_id || '.2' as record, 'CDS' as kind, gene_id as locus_tag, tx_id as id, strand, string_agg(cs || '-' || ce, ',' order by cs) as parts, 'long prod ' || (g % 9) as product, 1 as codon_start, 'MKVLLA' as translation from one group by gene_id, tx_id, strand, g
 union all select distinct tx_id || '.2', 'gene', gene_id, null, strand, g0 || '-' || g1, null, null, null from one""")
def _(t):
    f = B.genbank_features(B.read_genbank(t.spark, genbank_text(t))).where("kind in ('CDS', 'gene')")
    return f.select("record", "kind", "locus_tag", "id", "strand", F.array_join(F.transform("parts", lambda e: F.concat(e["start"], F.lit("-"), e["end"])), ",").alias("parts"), "product", "codon_start", "translation")


@query("s8_genbank_records", f"{GB1} select distinct tx_id || '.2' as record, 'Genus species' as organism, 2 as version, 'ACGTACGTACGTACGTACGTNNNN' as seq from one")
def _(t):
    return B.read_genbank(t.spark, genbank_text(t)).select("record", "organism", "version", "seq")


@query("s9_genbank_metadata", f"{GB1} select 'Genus species' as organism, 'iso1' as isolate, min(tx_id) as accession, 2 as version from (select tx_id from one order by tx_id || '.2' limit 1)")
def _(t):
    return B.genbank_metadata(B.read_genbank(t.spark, genbank_text(t))).select("organism", "isolate", "accession", "version")


@query("s22_antismash_clusters", f"{GB1} select distinct tx_id || '.2' as contig, g0 as \"start\", g1 as \"end\", 'Cluster_1' as name from one")
def _(t):
    r = B.read_genbank(t.spark, genbank_text(t)).withColumn("smash_version", F.lit(6))
    return B.antismash_clusters(r)


@query("s22_antismash_genes", f"{GB1} select distinct tx_id as gene_id, 't1pks' as backbone, 'KS' as domains, 'SMCOG1001: reg' as smcog from one")
def _(t):
    r = B.read_genbank(t.spark, genbank_text(t)).withColumn("smash_version", F.lit(6))
    return B.antismash_genes(r).select("gene_id", "backbone", "domains", "smcog")


@query("s10_read_bed", f"""with {V.MASK} select contig, "start", "end", name from mask""")
def _(t):
    return L.read_bed(t.spark, saved(K.bed_lines(V.mask(t)), "line"))


# difference strings: match, mismatch, intron, match, insertion, deletion, match
CS = """cs as (select l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey as query, case when l_linestatus = 'O' then 0 when l_suppkey % 9 = 0 then 4 else 16 end as flag, 'ctg' || l_suppkey as target, l_partkey + 1 as pos,
  l_linenumber * 10 as m1, cast(l_quantity as bigint) + 30 as il, cast(l_tax * 100 as bigint) as mm, l_suppkey % 3 = 0 as odd from lineitem),
 ok as (select *, case when flag = 0 then '+' else '-' end as strand, m1 + 25 + 2 + mm as n from cs where flag in (0, 16))"""


def sam_text(t):
    flag = F.when(C("l_linestatus") == "O", 0).when(C("l_suppkey") % 9 == 0, 4).otherwise(16)
    il = C("l_quantity").cast("long") + 30
    mm = F.round(C("l_tax") * 100).cast("int")
    ends = F.when(C("l_suppkey") % 3 == 0, F.concat(F.lit("~aa"), il, F.lit("tt"))).when(C("l_linestatus") == "O", F.concat(F.lit("~gt"), il, F.lit("ag"))).otherwise(F.concat(F.lit("~ct"), il, F.lit("ac")))
    cs = F.concat(F.lit("cs:Z::"), C("l_linenumber") * 10, F.repeat(F.lit("*ac"), mm), ends, F.lit(":20+gg-t:5"))
    n = C("l_linenumber") * 10 + 27 + mm
    v = tab(F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), flag, F.concat(F.lit("ctg"), "l_suppkey"), C("l_partkey") + 1, "60", "*", "*", "0", "0", F.repeat(F.lit("A"), n), "*", F.concat(F.lit("NM:i:"), mm + 2), cs)
    li = spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_quantity", "l_tax"))
    return li.select(v.alias("value"))


@query("s11_read_sam", f"with {CS} select query, flag, target, pos, n as seq_len, cast(mm + 2 as int) as nm from ok")
def _(t):
    return L.read_sam(t.spark, saved(sam_text(t))).select("query", "flag", "target", "pos", "seq_len", "nm")


@query("f10_expand_cs", f"""with {CS} select query, strand, pos || '-' || (pos + m1 - 1) || '/' || case when strand = '+' then 1 || '-' || m1 else (n - m1 + 1) || '-' || n end || ',' || (pos + m1 + il) || '-' || (pos + m1 + il + 24) || '/' || case when strand = '+' then (m1 + 1) || '-' || n else 1 || '-' || (n - m1) end as blocks,
 m1 + 25 as matches, 2 as gaps, not odd as proper_splice, round(100.0 * (m1 + 25) / (m1 + 25 + mm), 4) as pident from ok""")
def _(t):
    e = AL.expand_cs(L.parse_sam(sam_text(t)))
    txt = F.array_join(F.transform("exons", lambda x: F.concat(x["start"], F.lit("-"), x["end"], F.lit("/"), x["qstart"], F.lit("-"), x["qend"])), ",")
    return e.select("query", "strand", txt.alias("blocks"), "matches", C("gaps").cast("int").alias("gaps"), "proper_splice", F.round("pident", 4).alias("pident"))


@query("p6_filter_spliced", f"""with {CS}, p as (select *, 100.0 * (m1 + 25) / (m1 + 25 + mm) as pid from ok) select query, strand, case when pid > 95 then 'cDNA_match' else 'EST_match' end as feature from p where not odd and pid >= 90""")
def _(t):
    return AL.filter_spliced(AL.expand_cs(L.parse_sam(sam_text(t))), 90.0).select("query", "strand", "feature")


@query("f11_canonical_splice", """with d as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, (['gt', 'at', 'ct', 'gc'])[l_partkey % 4 + 1] || l_linenumber || (['ag', 'ac', 'at', 'tt'])[l_suppkey % 4 + 1] as tok, case when l_linestatus = 'O' then '+' else '-' end as strand from lineitem)
 select *, case when strand = '+' then (tok like 'gt%ag' or tok like 'at%ac') else (tok like 'ct%ac' or tok like 'gt%at') end as canonical from d""")
def _(t):
    pick = lambda xs, i: F.get(F.array(*[F.lit(x) for x in xs]), i.cast("int"))
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat(pick(["gt", "at", "ct", "gc"], C("l_partkey") % 4), "l_linenumber", pick(["ag", "ac", "at", "tt"], C("l_suppkey") % 4)).alias("tok"),
                          F.when(C("l_linestatus") == "O", "+").otherwise("-").alias("strand"))
    return d.withColumn("canonical", AL.is_canonical_splice(C("tok"), C("strand")))


@query("f24_span_overlap", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(case when l_quantity > 0 then greatest(least(l_partkey + l_quantity, l_suppkey * 20 + 30) - greatest(l_partkey, l_suppkey * 20), 0) / l_quantity else 0.0 end, 6) as ratio from lineitem""")
def _(t):
    r = AL.span_overlap(C("l_partkey"), C("l_partkey") + C("l_quantity"), C("l_suppkey") * 20, C("l_suppkey") * 20 + 30)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(r, 6).alias("ratio"))


@query("k8_alignment_lines", f"""with {CS}, p as (select *, printf('%.2f', 100.0 * (m1 + 25) / (m1 + 25 + mm)) as pid from ok), b as (
  select query, target, strand, pid, pos as s, pos + m1 - 1 as e, case when strand = '+' then 1 else n - m1 + 1 end as qs, case when strand = '+' then m1 else n end as qe from p
  union all select query, target, strand, pid, pos + m1 + il, pos + m1 + il + 24, case when strand = '+' then m1 + 1 else 1 end, case when strand = '+' then n else n - m1 end from p)
 select target || chr(9) || 'genome' || chr(9) || 'cDNA_match' || chr(9) || s || chr(9) || e || chr(9) || pid || chr(9) || strand || chr(9) || '.' || chr(9) || 'ID=' || query || ';Target=' || query || ' ' || qs || ' ' || qe as line from b""")
def _(t):
    return K.alignment_lines(AL.expand_cs(L.parse_sam(sam_text(t)))).select("line")


@query("s12_alignment_gff", """with r as (select 'a' || l_orderkey as id, 'c' || (l_suppkey % 3) as contig, case when l_linestatus = 'O' then '+' else '-' end as strand, l_linenumber * 1000 + l_partkey as s, l_linenumber * 1000 + l_partkey + 20 as e, 't' || l_orderkey as target from lineitem),
 f as (select *, first_value(contig) over w as fc, first_value(strand) over w as fs from r window w as (partition by id order by s, contig, strand)) select id, target, contig, strand, s as "start", e as "end" from f where contig = fc and strand = fs""")
def _(t):
    s = C("l_linenumber") * 1000 + C("l_partkey")
    v = tab(F.concat(F.lit("c"), C("l_suppkey") % 3), "x", "cDNA_match", s, s + 20, ".", F.when(C("l_linestatus") == "O", "+").otherwise("-"), ".", F.concat(F.lit("ID=a"), "l_orderkey", F.lit(";Target=t"), "l_orderkey", F.lit(" 1 20 +")))
    return L.alignment_gff(L.parse_gff3(t.lineitem.select(v.alias("value")))).select("id", "target", "contig", "strand", "start", "end")


@query("s13_read_paf", """select 'r' || l_partkey as query, l_quantity::bigint as qlen, 'c' || l_suppkey as target, l_linenumber::bigint as mapq, round(l_discount, 2) as de from lineitem""")
def _(t):
    v = tab(F.concat(F.lit("r"), "l_partkey"), C("l_quantity").cast("long"), "0", "10", "+", F.concat(F.lit("c"), "l_suppkey"), "1000", "5", "15", "9", "10", C("l_linenumber"), "tp:A:P", F.concat(F.lit("de:f:"), F.format_string("%.2f", "l_discount")))
    return L.read_paf(t.spark, saved(t.lineitem.select(v.alias("value")))).select("query", "qlen", "target", "mapq", "de")


@query("s14_read_blast_tab", """select 'p' || l_partkey as sseqid, 'c' || l_suppkey as qseqid, l_linenumber::bigint as sstart, l_quantity as pident, case when l_linestatus = 'O' then 1::bigint else -1::bigint end as qframe from lineitem""")
def _(t):
    v = tab(F.concat(F.lit("p"), "l_partkey"), "100", C("l_linenumber"), "90", F.concat(F.lit("c"), "l_suppkey"), "5000", "10", "300", C("l_quantity"), "80", "1e-20", "150.5", "88", F.when(C("l_linestatus") == "O", "1").otherwise("-1"))
    return L.read_blast_tab(t.spark, saved(t.lineitem.select(v.alias("value")))).select("sseqid", "qseqid", "sstart", "pident", "qframe")


@query("s15_read_blast_xml", """select 'g' || p_partkey as query, 100 + p_size as qlen, 'Product OS=S GN=ABC' || p_size as description, p_size as n_ident, 60 as aln_len, p_retailprice as bitscore from part""")
def _(t):
    hit = lambda d, n: F.concat(F.lit("<Hit><Hit_num>1</Hit_num><Hit_id>sp|x</Hit_id><Hit_def>"), d, F.lit("</Hit_def><Hit_len>90</Hit_len><Hit_hsps><Hsp><Hsp_num>1</Hsp_num><Hsp_bit-score>"), "p_retailprice",
                                F.lit("</Hsp_bit-score><Hsp_evalue>1e-9</Hsp_evalue><Hsp_query-from>1</Hsp_query-from><Hsp_query-to>60</Hsp_query-to><Hsp_hit-from>1</Hsp_hit-from><Hsp_hit-to>60</Hsp_hit-to><Hsp_identity>"), n,
                                F.lit("</Hsp_identity><Hsp_align-len>60</Hsp_align-len></Hsp></Hit_hsps></Hit>"))
    v = F.concat(F.lit("<Iteration><Iteration_query-def>g"), "p_partkey", F.lit(" extra</Iteration_query-def><Iteration_query-len>"), C("p_size") + 100, F.lit("</Iteration_query-len><Iteration_hits>"),
                 hit(F.concat(F.lit("Product OS=S GN=ABC"), "p_size"), C("p_size")), hit(F.lit("second"), F.lit(1)), F.lit("</Iteration_hits></Iteration>"))
    return X.read_blast_xml(t.spark, saved_xml(t.part.select(v.alias("value")), "BlastOutput_iterations")).select("query", "qlen", "description", "n_ident", "aln_len", "bitscore")


@query("s16_read_domtblout", """select 'PF' || (p_partkey % 50) as target, 'g' || p_partkey as query, p_size as hmm_start, p_size + 40 as hmm_end, 3e-20 as evalue from part""")
def _(t):
    v = F.concat_ws("   ", F.concat(F.lit("PF"), C("p_partkey") % 50), F.lit("PF0001.3"), F.lit("120"), F.concat(F.lit("g"), "p_partkey"), F.lit("-"), F.lit("300"), F.lit("3e-20"), F.lit("80.1"), F.lit("0.0"), F.lit("1"), F.lit("1"), F.lit("1e-22"), F.lit("3e-20"), F.lit("80.0"), F.lit("0.0"),
                    (C("p_size") + 1).cast("string"), (C("p_size") + 40).cast("string"), F.lit("5"), F.lit("90"), F.lit("4"), F.lit("91"), F.lit("0.95"), F.lit("some text here"))
    rows = t.part.select(F.explode_outer(F.array(v, F.when(C("p_partkey") % 100 == 0, F.lit("# footer")))).alias("value")).where("value is not null")
    return L.read_domtblout(t.spark, saved(rows)).select("target", "query", "hmm_start", "hmm_end", "evalue")


@query("s17_interproscan", """select distinct 'g' || p_partkey as id, 'db_xref' as ref_db, 'InterPro:IPR' || p_size as value from part union all select distinct 'g' || p_partkey, 'go_process', 'name ' || p_size || '|000' || p_size || '||IEA' from part""")
def _(t):
    m = F.concat(F.lit('<hmmer3-match><signature ac="PF1"><entry ac="IPR'), "p_size", F.lit('"><go-xref category="BIOLOGICAL_PROCESS" id="GO:000'), "p_size", F.lit('" name="name '), "p_size", F.lit('"/></entry></signature></hmmer3-match>'))
    v = F.concat(F.lit("<protein><sequence>MKV</sequence><xref id=\"g"), "p_partkey", F.lit("\"/><matches>"), m, m, F.lit("<panther-match><signature ac=\"P2\"/></panther-match></matches></protein>"))
    return X.interproscan_annotations(X.read_interproscan_xml(t.spark, saved_xml(t.part.select(v.alias("value")), "protein-matches")))


@query("s18_read_eggnog", """select 'g' || p_partkey as query, 'A@1|root,B' || p_size || '@2|Fungi' as ogs, '2|Fungi' as tax, 'SYM' || p_size as symbol, 'KL' as cogs, '1.1.1.' || p_size as ec, 'Descr. tail' as description from part""")
def _(t):
    head = "#query\tseed_ortholog\tevalue\tscore\teggNOG_OGs\tmax_annot_lvl\tCOG_category\tDescription\tPreferred_name\tGOs\tEC"
    v = tab(F.concat(F.lit("g"), "p_partkey"), "x", "1e-5", "50", F.concat(F.lit("A@1|root,B"), "p_size", F.lit("@2|Fungi")), "2|Fungi", "KL", "Descr. tail", F.concat(F.lit("SYM"), "p_size"), "-", F.concat(F.lit("1.1.1."), "p_size"))
    rows = t.part.select(F.explode_outer(F.array(F.when(C("p_partkey") == 0, F.lit("## emapper-2.1.9\n" + head)), v)).alias("value")).where("value is not null")
    return L.read_eggnog(t.spark, saved(rows))


@query("s19_read_signalp", """select 'g' || p_partkey as id, cast(p_size as varchar) as "end", 'ASA' as cut, '0.9' as prob from part where p_size % 3 = 0""")
def _(t):
    v = tab(F.concat(F.lit("g"), "p_partkey"), F.when(C("p_size") % 3 == 0, "SP(Sec/SPI)").otherwise("OTHER"), "0.9", "0.1", F.concat(F.lit("CS pos: "), "p_size", F.lit("-20. AS.A Pr: 0.9")))
    rows = t.part.select(F.explode_outer(F.array(F.when(C("p_partkey") == 0, F.lit("# SignalP-5.0\tOrganism: euk")), v)).alias("value")).where("value is not null")
    return L.parse_signalp(rows.withColumn("value", F.replace("value", F.lit("AS.A"), F.lit("ASA."))), L.signalp_version(rows))


@query("s20_read_phobius", """select 'g' || p_partkey as id, p_size % 5 as tm, case when p_size % 2 = 0 then 'Y' else '0' end as sp, 'i' || p_size || 'o' as prediction from part""")
def _(t):
    v = F.concat_ws("   ", F.concat(F.lit("g"), "p_partkey"), (C("p_size") % 5).cast("string"), F.when(C("p_size") % 2 == 0, "Y").otherwise("0"), F.concat(F.lit("i"), "p_size", F.lit("o")))
    rows = t.part.select(F.explode_outer(F.array(F.when(C("p_partkey") == 0, F.lit("SEQENCE ID                     TM SP PREDICTION")), v)).alias("value")).where("value is not null")
    return L.read_phobius(t.spark, saved(rows))


@query("s21_read_busco", """select 'B' || p_partkey as busco, case when p_size > 10 then 'Complete' else 'Missing' end as status, case when p_size > 10 then 'c' || p_size end as contig, case when p_size > 10 then p_partkey end as "start" from part""")
def _(t):
    full = tab(F.concat(F.lit("B"), "p_partkey"), "Complete", F.concat(F.lit("c"), "p_size"), C("p_partkey"), C("p_partkey") + 90, "300.5", "90")
    v = F.when(C("p_size") > 10, full).otherwise(tab(F.concat(F.lit("B"), "p_partkey"), "Missing"))
    return L.read_busco(t.spark, saved(t.part.select(v.alias("value")))).select("busco", "status", "contig", "start")


@query("s23_read_obo", """select 'GO:' || lpad(cast(p_partkey as varchar), 7, '0') as go_id, p_name as name, 'molecular_function' as namespace, 'GO:A' || p_size as alts, 'GO:' || lpad(cast(p_partkey // 2 as varchar), 7, '0') as parents from part""")
def _(t):
    gid = lambda c: F.concat(F.lit("GO:"), F.lpad(c.cast("string"), 7, "0"))
    v = F.concat(F.lit("[Term]\nid: "), gid(C("p_partkey")), F.lit("\nname: "), "p_name", F.lit("\nnamespace: molecular_function\nalt_id: GO:A"), "p_size", F.lit("\nis_a: "), gid(F.expr("p_partkey div 2")), F.lit(" ! parent\n"))
    path = saved(t.part.select(F.concat(F.lit("\n"), v).alias("value")))
    o = B.read_obo(t.spark, path)
    return o.select("go_id", "name", "namespace", F.array_join("alt_ids", ",").alias("alts"), F.array_join("parents", ",").alias("parents"))


@query("s24_read_lookup", """select 'IPR' || p_partkey as term, p_name as description from part""")
def _(t):
    return L.read_lookup(t.spark, "interpro", saved(t.part.select(tab(F.concat(F.lit("IPR"), "p_partkey"), "Domain", C("p_name")).alias("value"))))


@query("s24_merops_lookup", """select 'MER' || p_partkey as term, 'A' || p_size || '.1' as description from part""")
def _(t):
    v = F.concat(F.lit(">MER"), "p_partkey", F.lit(" #A"), "p_size", F.lit(".1\nMKV"))
    return L.read_lookup(t.spark, "merops", saved(t.part.select(v.alias("value"))))


@query("s24_interpro_entries", """select 'IPR' || p_partkey as term, p_name as description from part where p_partkey in (select l_partkey from lineitem where l_quantity = 50)""")
def _(t):
    v = F.concat(F.lit('<interpro id="IPR'), "p_partkey", F.lit('" type="Domain"><name>'), "p_name", F.lit("</name></interpro>"))
    wanted = t.lineitem.where("l_quantity = 50").select(F.concat(F.lit("IPR"), "l_partkey").alias("term"))
    return X.read_interpro_entries(t.spark, saved_xml(t.part.select(v.alias("value")), "interprodb"), wanted)


@query("s25_custom_annotations", f"""with {V.ANNOTS} select id, ref_db, value from annots where event_id % 3 > 0""")
def _(t):
    v = F.when(C("event_id") % 3 == 0, tab(C("id"), C("ref_db"))).otherwise(tab(C("id"), C("ref_db"), C("value")))
    return L.read_custom_annotations(t.spark, saved(V.annots(t).select(v.alias("value"))))


@query("s27_zff_models", f"""with {GM} select gene_id || '-T' || t as gene_id, contig, strand, string_agg(s || '-' || e, ',' order by s) as exons from gm group by gene_id, t, contig, strand""")
def _(t):
    g = gene_table(t)
    rows = g.select("contig", "tx_id", "strand", F.explode_outer("exons").alias("e")).select(
        "contig", tab("Exon", C("e.start"), C("e.end"), C("strand"), "1.5", "0", "0", "1", C("tx_id")).alias("l"), "tx_id")
    b = rows.groupBy("contig", "tx_id").agg(F.array_join(F.sort_array(F.collect_list("l")), "\n").alias("l"))
    m = P.zff_models(B.read_zff(t.spark, saved(b.select(F.concat(F.lit(">"), "contig", F.lit("\n"), "l").alias("value")))))
    return m.select("gene_id", "contig", "strand", F.array_join(F.transform("exons", lambda e: F.concat(e["start"], F.lit("-"), e["end"])), ",").alias("exons"))


def predictor_text(t, anchor):
    g = gene_table(t).withColumn("gene_id", F.col("tx_id"))
    top = g.select(tab(C("contig"), "P", anchor, C("gene_start"), C("gene_end"), ".", C("strand"), ".", F.concat(F.lit("ID="), "gene_id", F.lit(" x;Name=y"))).alias("value"))
    cds = g.select("contig", "strand", "gene_id", F.explode_outer("cds").alias("c")).select(tab(C("contig"), "P", "CDS", C("c.start"), C("c.end"), ".", C("strand"), "0", F.concat(F.lit("ID=z;Parent="), "gene_id")).alias("value"))
    return top.unionByName(cds)


PRED = """one as (select * exclude (gene_id), tx_id as gene_id from gm), nm as (select gene_id, row_number() over (order by contig, g0, gene_id) as n from (select distinct gene_id, contig, g0 from one)),
 j as (select one.* exclude (n), nm.n, row_number() over (partition by gene_id order by cs) as i from one join nm using (gene_id))"""


@query("s28_glimmer_features", f"""with {GM}, {PRED} select distinct contig, 'gene' as feature, g0 as "start", g1 as "end", 'glimmerG_' || n as id, null as parent from j
 union all select distinct contig, 'mRNA', g0, g1, 'glimmerT_' || n || '-T1', 'glimmerG_' || n from j union all select contig, 'exon', cs, ce, 'glimmerT_' || n || '-T1.exon' || i, 'glimmerT_' || n || '-T1' from j
 union all select contig, 'CDS', cs, ce, 'glimmerT_' || n || '-T1.cds', 'glimmerT_' || n || '-T1' from j""")
def _(t):
    return P.glimmer_features(L.parse_gff3(predictor_text(t, "mRNA"))).select("contig", "feature", "start", "end", "id", "parent")


@query("s29_codingquarry_features", f"""with {GM}, {PRED} select distinct contig, 'gene' as feature, g0 as "start", g1 as "end", 'gene_' || n as id, null as parent from j
 union all select distinct contig, 'mRNA', g0, g1, 'transcript_' || n || '-T1', 'gene_' || n from j union all select contig, 'exon', cs, ce, 'transcript_' || n || '-T1.exon' || i, 'transcript_' || n || '-T1' from j
 union all select contig, 'CDS', cs, ce, 'transcript_' || n || '-T1.cds', 'transcript_' || n || '-T1' from j""")
def _(t):
    return P.codingquarry_features(L.parse_gff3(predictor_text(t, "gene"))).select("contig", "feature", "start", "end", "id", "parent")


@query("s30_split_maker", """with m as (select (['maker', 'protein2genome', 'est2genome', 'pred_gff:snap', 'blastx'])[l_suppkey % 5 + 1] as src, case when l_partkey % 3 = 0 then 'gene' else 'match_part' end as f, l_partkey as s from lineitem),
 r as (select *, case when src = 'maker' then 'prediction' when src = 'protein2genome' and f = 'match_part' then 'protein' when src in ('est2genome', 'pred_gff:snap') and f = 'match_part' then 'transcript' end as route from m)
 select replace(src, 'pred_gff:', '') as source, case route when 'protein' then 'nucleotide_to_protein_match' when 'transcript' then 'EST_match' else f end as feature, s as "start", case when src = 'pred_gff:snap' then 100.0::double when route = 'prediction' then 7.5::double end as score, route from r where route is not null""")
def _(t):
    src = F.get(F.array(*[F.lit(x) for x in ("maker", "protein2genome", "est2genome", "pred_gff:snap", "blastx")]), (C("l_suppkey") % 5).cast("int"))
    v = tab("c1", src, F.when(C("l_partkey") % 3 == 0, "gene").otherwise("match_part"), C("l_partkey"), C("l_partkey") + 5, "7.5", "+", ".", "ID=x")
    return L.split_maker(L.parse_gff3(t.lineitem.select(v.alias("value")))).select("source", "feature", "start", "score", "route")


@query("s31_read_exonerate", f"""with {GM}, o as (select *, row_number() over (partition by tx_id order by s) as i from gm) select contig, s as "start", e as "end", tx_id as target, cast(i as int) as part, i * 30 as t_start, i * 30 + (e - s) // 3 as t_end from o""")
def _(t):
    g = gene_table(t)
    ex = F.array_join(F.transform("exons", lambda e: F.concat_ws("\t", C("contig"), F.lit("exonerate"), F.lit("exon"), e["start"].cast("string"), e["end"].cast("string"), F.lit("."), C("strand"), F.lit("."), F.lit("insertions 0"))), "\n")
    al = F.array_join(F.transform("exons", lambda e, i: F.concat(F.lit("Align 1 "), (i + 1) * 30, F.lit(" "), e["end"] - e["start"])), " ; ")
    v = F.concat_ws("\n", F.lit("##gff-version 2"), F.concat_ws("\t", C("contig"), F.lit("exonerate"), F.lit("gene"), C("gene_start"), C("gene_end"), F.lit("1"), C("strand"), F.lit("."), F.concat(F.lit("gene_id 1 ; sequence "), "tx_id", F.lit(" ; gene_orientation +"))),
                    ex, F.concat_ws("\t", C("contig"), F.lit("exonerate"), F.lit("similarity"), C("gene_start"), C("gene_end"), F.lit("1"), C("strand"), F.lit("."), F.concat(F.lit("alignment_id 1 ; Query x ; "), al)), F.lit("AveragePercentIdentity: 91.5"))
    return B.read_exonerate(t.spark, saved(g.select(v.alias("value")))).select("contig", "start", "end", "target", "part", "t_start", "t_end")


@query("s32_augustus_support", """select 'g' || p_partkey as gene_id, p_size * 2.0::double as support from part""")
def _(t):
    v = F.concat(F.lit("# start gene g"), "p_partkey", F.lit("\nc1\tAUGUSTUS\tgene\t1\t90\t.\t+\t.\tg\n# % of transcript supported by hints (any source): "), C("p_size") * 2.0, F.lit("\n# end gene g"), "p_partkey", F.lit("\n###"))
    return B.read_augustus_support(t.spark, saved(t.part.select(v.alias("value"))))


@query("s33_read_trnascan", """select 'c' || (p_partkey % 7) as contig, p_partkey as "start", p_partkey + 45 + p_size as "end", case when p_size % 2 = 0 then '+' else '-' end as strand, 'Ala' as kind from part where 45 + p_size between 50 and 150""")
def _(t):
    a, b = C("p_partkey"), C("p_partkey") + 45 + C("p_size")
    v = tab(F.concat(F.lit("c"), C("p_partkey") % 7, F.lit(" ")), "1", F.when(C("p_size") % 2 == 0, a).otherwise(b), F.when(C("p_size") % 2 == 0, b).otherwise(a), "Ala", "AGC", "0", "0", "70.1")
    rows = t.part.select(F.explode_outer(F.array(F.when(C("p_partkey") == 0, F.lit("Sequence\ttRNA\nName\ttRNA\n--------\t------")), v)).alias("value")).where("value is not null")
    return L.read_trnascan(t.spark, saved(rows)).select("contig", "start", "end", "strand", "kind")


@query("s34_read_abundance", """select 't' || l_orderkey || '.' || l_linenumber as tx_id, 'g' || l_orderkey as gene_id, 'c' || l_suppkey || ':1-9' as location, l_quantity as tpm from lineitem""")
def _(t):
    v = tab(F.concat(F.lit("t"), "l_orderkey", F.lit("."), "l_linenumber"), F.concat(F.lit("g"), "l_orderkey"), F.concat(F.lit("c"), "l_suppkey", F.lit(":1-9")), C("l_quantity"))
    return L.read_abundance(t.spark, saved(t.lineitem.select(v.alias("value"))))


@query("s35_read_blocks", """select 'B' || p_partkey || chr(10) || p_name as block from part""")
def _(t):
    v = F.concat(F.lit("\n@@"), "p_partkey", F.lit("\n"), "p_name")
    b = B.read_blocks(t.spark, saved(t.part.select(v.alias("value"))), "\n@@").where("trim(value) != ''")
    return b.select(F.concat(F.lit("B"), F.rtrim(F.col("value"), F.lit("\n"))).alias("block"))


@query("s36_read_validation", """select 'GEN_' || p_partkey as gene_id, 'Bad ' || p_size as reason from part where p_size % 4 = 0""")
def _(t):
    v = F.when(C("p_size") % 4 == 0, F.concat(F.lit("ERROR: valid [SEQ_FEAT.X] Bad "), "p_size", F.lit(" FEATURE: CDS: x [lcl|GEN_"), "p_partkey", F.lit("-T1"))).otherwise(F.lit("WARNING: valid"))
    return L.read_validation(t.spark, saved(t.part.select(v.alias("value"))), "GEN_")


@query("s36_discrepancies", """select 'SUB:SUSPECT' as section, p_size || ' features bad' as reason, false as is_trna, 'G' || p_partkey as gene_id from part""")
def _(t):
    v = F.concat(F.lit("\nDiscRep_SUB:SUSPECT::"), "p_size", F.lit(" features bad\ngenome:CDS\tprod\tlcl|c:1-9\tG"), "p_partkey", F.lit("\n"))
    return B.read_discrepancies(t.spark, saved(t.part.select(v.alias("value"))))


@query("s37_intron_hints", """select 'c' || l_suppkey as contig, l_partkey as "start", l_partkey + 50 as "end", case when l_linenumber > 3 then l_linenumber::bigint else 1::bigint end as mult from lineitem""")
def _(t):
    at = F.when(C("l_linenumber") > 3, F.concat(F.lit("mult="), "l_linenumber", F.lit(";pri=4;src=E"))).otherwise(F.lit("pri=4;src=E"))
    v = tab(F.concat(F.lit("c"), "l_suppkey"), "b2h", "intron", C("l_partkey"), C("l_partkey") + 50, "0", "+", ".", at)
    return L.parse_intron_hints(t.lineitem.select(v.alias("value"))).select("contig", "start", "end", "mult")


@query("k20_write_partitioned", f"with {V.SEQS} select seq_id, length(seq) as n from seqs")
def _(t):
    path = scratch_path(t.spark, "parts")
    K.write_partitioned(V.seqs(t), path)
    return B.read_fasta(t.spark, path).select("seq_id", F.length("seq").cast("long").alias("n"))


@query("s14_read_tblastn_tab", """select 'p' || l_partkey as sseqid, 'c' || l_suppkey as qseqid, l_linenumber::bigint as sstart, l_quantity as pident, l_extendedprice as score from lineitem""")
def _(t):
    v = tab(F.concat(F.lit("p"), "l_partkey"), "100", C("l_linenumber"), "90", F.concat(F.lit("c"), "l_suppkey"), "5000", "10", "300", C("l_quantity"), "80", "1e-20", C("l_extendedprice"))
    return L.read_blast_tab(t.spark, saved(t.lineitem.select(v.alias("value"))), L.BLAST_TAB_12).select("sseqid", "qseqid", "sstart", "pident", "score")


@query("s19_read_signalp6", """select 'g' || p_partkey as id, cast(p_size as varchar) as "end", '' as cut, '0.97' as prob from part where p_size % 3 = 0""")
def _(t):
    v = tab(F.concat(F.lit("g"), "p_partkey", F.lit(" some text")), F.when(C("p_size") % 3 == 0, "SP").otherwise("OTHER"), "0.01", "0.99", F.concat(F.lit("CS pos: "), "p_size", F.lit("-20. Pr: 0.97")))
    head = t.part.where("p_partkey = 1").select(F.lit("# SignalP-6.0\tOrganism: Eukarya").alias("value"))
    return L.read_signalp(t.spark, saved(head.unionByName(t.part.select(v.alias("value")))))


@query("s19_read_signalp4", """select 'g' || p_partkey as id, cast(p_size - 1 as varchar) as "end", '' as cut, '' as prob from part where p_size % 3 = 0""")
def _(t):
    v = F.concat_ws("  ", F.concat(F.lit("g"), "p_partkey"), F.lit("0.1"), C("p_size").cast("string"), F.lit("0.2  11  0.3  4  0.4  0.5"), F.when(C("p_size") % 3 == 0, "Y").otherwise("N"), F.lit("0.45  SignalP-noTM"))
    head = t.part.where("p_partkey = 1").select(F.lit("# SignalP-4.1 euk predictions").alias("value"))
    return L.read_signalp(t.spark, saved(head.unionByName(t.part.select(v.alias("value")))))


@query("s21_read_busco_protein", """select 'B' || p_partkey as busco, case when p_size > 10 then 'Complete' else 'Missing' end as status, case when p_size > 10 then 'g' || p_size end as gene, case when p_size > 10 then p_retailprice end as score, case when p_size > 10 then p_partkey + 90 end as length from part""")
def _(t):
    full = tab(F.concat(F.lit("B"), "p_partkey"), "Complete", F.concat(F.lit("g"), "p_size"), C("p_retailprice"), C("p_partkey") + 90)
    v = F.when(C("p_size") > 10, full).otherwise(tab(F.concat(F.lit("B"), "p_partkey"), "Missing"))
    return L.read_busco(t.spark, saved(t.part.select(v.alias("value"))), "protein")


@query("s24_pfam_lookup", """select 'PF' || p_partkey as term, p_name as description from part""")
def _(t):
    return L.read_lookup(t.spark, "pfam", saved(t.part.select(tab(F.concat(F.lit("PF"), "p_partkey"), "CL1", "clan", "short", C("p_name")).alias("value"))))


@query("s24_curated_lookup", """select 'abc' || p_partkey as term, p_name as description from part""")
def _(t):
    head = t.part.where("p_partkey = 1").select(F.lit("#name\tproduct").alias("value"))
    return L.read_lookup(t.spark, "curated", saved(head.unionByName(t.part.select(tab(F.concat(F.lit("abc"), "p_partkey"), C("p_name")).alias("value")))))


@query("s24_factors_lookup", """select 'IPR' || p_partkey as term, p_name as description from part""")
def _(t):
    return L.read_lookup(t.spark, "factors", saved(t.part.select(F.concat(F.lit("IPR"), "p_partkey", F.lit(", "), "p_name").alias("value"))))


@query("s24_eggnog_lookup", """select 'ENOG' || p_partkey as term, p_name as description from part""")
def _(t):
    return L.read_lookup(t.spark, "eggnog", saved(t.part.select(tab(F.concat(F.lit("ENOG"), "p_partkey"), C("p_name")).alias("value"))))
