"""Registered sequence and assembly queries."""

from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import sequences as Q
from ..operators import stats as A
from . import views as V
from .registry import query

RC = "translate(reverse(regexp_replace(upper({s}), '[^ACGTUMRWSYKVHDBXN]', '', 'g')), 'ACGTUMRWSYKVHDBXN', 'TGCAAKYWSRMBDHVXN')"
# Complements of the nucleotide letters.
COMP = "ACGTUMRWSYKVHDBXN", "TGCAAKYWSRMBDHVXN"
# Published amino acid lines of NCBI tables in TCAG order, apart from the library's own tables.
PUBLISHED = {
    1: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    12: "FFLLSSSSYY**CC*WLLLSPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
}


def aa_sql(seq: str, offset: str = "0", table: int = 1) -> str:
    letters = PUBLISHED[table]
    idx = lambda i: f"(instr('TCAG', c[{i}]) - 1)"
    return (f"array_to_string(list_transform(regexp_extract_all(substr(upper({seq}), 1 + {offset}), '.{{3}}'), lambda c: "
            f"case when regexp_full_match(c, '[TCAG]{{3}}') then substr('{letters}', {idx(1)} * 16 + {idx(2)} * 4 + {idx(3)} + 1, 1) else 'X' end), '')")


@query("f1_revcomp", f"with {V.SEQS} select seq_id, {RC.format(s='seq')} as rc from seqs")
def _(t):
    return V.seqs(t).select("seq_id", S.revcomp(F.col("seq")).alias("rc"))


@query("f2_translate", f"with {V.DNA} select seq_id, {aa_sql('seq', 'doc_id % 3')} as protein, {aa_sql('seq', '0', 12)} as protein12 from dna")
def _(t):
    return V.dna(t).select("seq_id", S.translate(F.col("seq"), (F.col("doc_id") % 3).cast("int")).alias("protein"),
                           S.translate(F.col("seq"), 0, 12).alias("protein12"))


@query("f2_translate_minus", f"with {V.SEQS} select seq_id, {aa_sql(RC.format(s='seq'))} as protein from seqs")
def _(t):
    return V.seqs(t).select("seq_id", S.translate_cds(F.col("seq"), F.lit("-")).alias("protein"))


@query("f3_six_frames", f"with {V.DNA}, r as (select *, {RC.format(s='seq')} as rc from dna) select seq_id, {aa_sql('seq')} as f1, "
       f"{aa_sql('seq', '1')} as f2, {aa_sql('seq', '2')} as f3, {aa_sql('rc')} as r1, {aa_sql('rc', '2')} as r2, {aa_sql('rc', '1')} as r3 from r")
def _(t):
    six = V.dna(t).select("seq_id", S.six_frames(F.col("seq")).alias("f"))
    return six.select("seq_id", *[F.col("f")[i].alias(n) for i, n in enumerate(["f1", "f2", "f3", "r1", "r2", "r3"])])


@query("f4_translate_transcripts", f"""with {V.DNA}, h as (select seq_id || ' gene codon_start=' || (doc_id % 3 + 1) as header, doc_id, seq from dna)
 select header, {aa_sql('seq', 'doc_id % 3')} as protein from h""")
def _(t):
    h = V.dna(t).select(F.concat("seq_id", F.lit(" gene codon_start="), F.col("doc_id") % 3 + 1).alias("header"), "seq")
    return h.select("header", S.translate_transcript(F.col("header"), F.col("seq")).alias("protein"))


@query("f7_gc_percent", f"""with {V.SEQS} select seq_id, case when length(seq) > 0 then
 round((length(seq) - length(regexp_replace(upper(seq), '[GCS]', '', 'g'))) * 100.0 / length(seq), 4) else 0.0 end as gc from seqs""")
def _(t):
    return V.seqs(t).select("seq_id", F.round(S.gc_percent(F.col("seq")), 4).alias("gc"))


@query("f13_best_frame", f"""with {V.DNA}, p as (select seq_id, {aa_sql('seq', '0')} as a, {aa_sql('seq', '1')} as b, {aa_sql('seq', '2')} as c from dna),
 s as (select seq_id, length(replace(a, '*', '*.')) - length(a) - (case when a like '%*' then 1 else 0 end) as sa,
 length(replace(b, '*', '*.')) - length(b) - (case when b like '%*' then 1 else 0 end) as sb,
 length(replace(c, '*', '*.')) - length(c) - (case when c like '%*' then 1 else 0 end) as sc from p)
 select seq_id, cast(least(sa, sb, sc) as int) as stops, case when sa <= sb and sa <= sc then 1 when sb <= sc then 2 else 3 end as frame from s""")
def _(t):
    b = V.dna(t).select("seq_id", S.best_frame(F.col("seq"), F.lit("+")).alias("b"))
    return b.select("seq_id", "b.stops", "b.frame")


@query("f14_trim_terminal_n", f"""with {V.SEQS}, n as (select seq_id, repeat('N', cast(length(seq) % 4 as int)) || seq || repeat('N', cast(length(seq) % 3 as int)) as seq from seqs),
 l as (select seq_id, seq, regexp_replace(seq, '^N+', '') as a from n), b as (select *, regexp_replace(a, 'N+$', '') as z from l)
 select seq_id, z as trimmed, 101 + length(seq) - length(a) as "start", 500 - (length(a) - length(z)) as "end" from b""")
def _(t):
    n = F.length("seq")
    padded = V.seqs(t).select("seq_id", F.concat(F.repeat(F.lit("N"), n % 4), "seq", F.repeat(F.lit("N"), n % 3)).alias("seq"))
    trim = padded.select("seq_id", S.trim_terminal_n(F.col("seq")).alias("t"))
    one = F.array(F.struct(F.lit(101).cast("long").alias("start"), F.lit(500).cast("long").alias("end")))
    done = trim.select("seq_id", F.col("t.seq").alias("trimmed"), S.trim_exons(one, F.col("t.left"), F.col("t.right")).alias("e"))
    return done.select("seq_id", "trimmed", F.col("e")[0]["start"].alias("start"), F.col("e")[0]["end"].alias("end"))


@query("f15_natural_sort", """select p_name, 'x' || p_partkey || p_brand as name,
 row_number() over (order by p_partkey, cast(regexp_extract(p_brand, '([0-9]+)', 1) as bigint)) as pos from part""")
def _(t):
    from ..scale import number_rows
    p = t.part.select("p_name", F.concat(F.lit("x"), "p_partkey", "p_brand").alias("name"))
    keyed = p.withColumn("_k", S.natural_key(F.col("name")))
    return number_rows(keyed, ["_k"], "pos").drop("_k")


@query("f17_partial_flags", f"""with {V.DNA}, p as (select seq_id, doc_id, {aa_sql('seq')} as protein from dna)
 select seq_id, not (doc_id % 2 = 0 and protein like 'M%') as partial_start, not (protein like '%*') as partial_stop from p""")
def _(t):
    p = V.dna(t).select("seq_id", "doc_id", S.translate(F.col("seq")).alias("protein"))
    return p.select("seq_id", S.partial_start(F.col("protein"), F.col("doc_id") % 2 + 1).alias("partial_start"),
                    S.partial_stop(F.col("protein")).alias("partial_stop"))


def run_sql(src, letters, min_len):
    return f"""ch as (select seq_id, unnest(string_split(seq, '')) as c, unnest(range(1, length(seq) + 1)) as p from {src} where length(seq) > 0),
 m as (select seq_id, p, p - row_number() over (partition by seq_id order by p) as g from ch where regexp_full_match(c, '[{letters}]')),
 r as (select seq_id, min(p) as "start", max(p) as "end" from m group by seq_id, g having count(*) >= {min_len})"""


@query("f8_mask_intervals", f"with {V.SEQS}, {run_sql('seqs', 'a-z', 1)} select * from r")
def _(t):
    return Q.mask_intervals(V.seqs(t))


@query("f8_mask_with_gaps", f"with {V.SEQS}, {run_sql('seqs', 'a-zN', 1)} select * from r")
def _(t):
    return Q.mask_intervals(V.seqs(t), include_gaps=True)


@query("f8_gap_intervals", f"with {V.SEQS}, {run_sql('seqs', 'Nn', 1)} select * from r")
def _(t):
    return Q.gap_intervals(V.seqs(t))


@query("f9_split_at_gaps", f"""with {V.SEQS}, {run_sql('seqs', 'Nn', 2)}, lens as (select seq_id, length(seq) as n from seqs where length(seq) > 0),
 mk as (select seq_id, "start", "end" from r union all select seq_id, n + 1, n + 1 from lens),
 ct as (select seq_id, coalesce(lag("end") over (partition by seq_id order by "start"), 0) + 1 as "start", "start" - 1 as "end" from mk),
 parts as (select seq_id, "start", "end", 'N' as kind from r union all select seq_id, "start", "end", 'W' from ct where "start" <= "end")
 select seq_id, "start", "end", kind, row_number() over (partition by seq_id order by "start") as part from parts""")
def _(t):
    return Q.split_at_gaps(V.seqs(t), min_n=2)


@query("k13_agp_contigs", f"""with {V.SEQS}, {run_sql('seqs', 'Nn', 2)}, lens as (select seq_id, length(seq) as n from seqs where length(seq) > 0),
 mk as (select seq_id, "start", "end" from r union all select seq_id, n + 1, n + 1 from lens),
 ct as (select seq_id, coalesce(lag("end") over (partition by seq_id order by "start"), 0) + 1 as "start", "start" - 1 as "end" from mk)
 select seq_id, "start", "end", 'contig_' || row_number() over (order by seq_id, "start") as contig from ct where "start" <= "end" """)
def _(t):
    return Q.name_contigs(Q.split_at_gaps(V.seqs(t), min_n=2)).select("seq_id", "start", "end", "contig")


@query("p27_mask_fraction", f"""with {V.SEQS} select cast(sum(length(seq) - length(regexp_replace(seq, '[a-z]', '', 'g'))) as bigint) as masked,
 cast(sum(length(seq)) as bigint) as total, round(sum(length(seq) - length(regexp_replace(seq, '[a-z]', '', 'g'))) / sum(length(seq)), 6) as fraction from seqs""")
def _(t):
    return Q.mask_fraction(V.seqs(t)).withColumn("fraction", F.round("fraction", 6))


EXONS = """ex as (select l_orderkey as tx_id, 'seq' || (l_orderkey % (select count(*) from documents)) as contig,
   l_linenumber * 90 + 1 as s, l_linenumber * 90 + 1 + cast(max(l_quantity) as bigint) as e from lineitem group by 1, 2, 3)"""


def exon_tx(t):
    n = t.documents.select(F.count(F.lit(1))).scalar()
    ex = t.lineitem.groupBy(F.col("l_orderkey").alias("tx_id"), (F.col("l_linenumber") * 90 + 1).cast("long").alias("start")).agg(
        (F.max(F.col("l_quantity").cast("long")) + F.col("start")).alias("end"))
    tx = ex.groupBy("tx_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("exons"))
    return tx.withColumn("contig", F.concat(F.lit("seq"), F.col("tx_id") % n))


@query("f5_splice", f"""with {V.DNA}, {EXONS} select tx_id, coalesce(string_agg(substr(seq, s, e - s + 1), '' order by s), '') as spliced
 from ex join dna on contig = seq_id group by tx_id""")
def _(t):
    return Q.splice(exon_tx(t), V.dna(t)).select("tx_id", "spliced")


@query("f6_extend_to_stop", f"""with {V.DNA}, {EXONS}, g as (select tx_id, contig, max(s) as ls, max(e) as le from ex group by 1, 2),
 a as (select g.*, d.seq, length(d.seq) as n, (select string_agg(substr(d.seq, x.s, x.e - x.s + 1), '' order by x.s) from ex x where x.tx_id = g.tx_id) as cds,
  (select string_agg(substr(d.seq, x.s, (case when x.s = g.ls then least(x.e + 60, length(d.seq)) else x.e end) - x.s + 1), '' order by x.s) from ex x where x.tx_id = g.tx_id) as wide
  from g join dna d on d.seq_id = g.contig where length(d.seq) > le),
 p as (select *, length({aa_sql('cds')}) as plen, instr({aa_sql('wide')}, '*') as stop from a)
 select tx_id, stop > 0 as extended, case when stop > 0 then le + (stop - plen) * 3 else le end as last_end from p""")
def _(t):
    tx = exon_tx(t).withColumnRenamed("exons", "cds").withColumn("strand", F.lit("+")).withColumn("phase", F.lit(0))
    lens = V.dna(t).select(F.col("seq_id").alias("contig"), F.length("seq").alias("_n"))
    tx = tx.join(lens, "contig").where(F.col("_n") > F.array_max(F.transform("cds", lambda c: c["end"]))).drop("_n")
    base = Q.splice(tx, V.dna(t), exons="cds", out="_c").withColumn("prot_len", F.length(S.translate(F.col("_c")))).drop("_c")
    out = Q.extend_to_stop(base, V.dna(t))
    return out.select("tx_id", "extended", F.element_at("cds", -1)["end"].alias("last_end"))


@query("f12_intron_strand", f"""with {V.DNA}, i as (select l_orderkey || '.' || l_linenumber as span_id, 'seq' || (l_orderkey % (select count(*) from documents)) as contig,
  l_linenumber * 40 + 1 as s, l_linenumber * 40 + 10 + q as e from (select l_orderkey, l_linenumber, cast(max(l_quantity) as bigint) as q from lineitem group by 1, 2)),
 m as (select i.*, lower(substr(seq, s, 2) || substr(seq, e - 1, 2)) as motif from i join dna on contig = seq_id where length(seq) > e)
 select span_id, motif, case when motif in ('gtag', 'gcag', 'atac') then '+'
  when lower({RC.format(s='motif')}) in ('gtag', 'gcag', 'atac') then '-' end as strand from m""")
def _(t):
    n = t.documents.select(F.count(F.lit(1))).scalar()
    i = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max(F.col("l_quantity").cast("long")).alias("q")).select(
        F.concat_ws(".", "l_orderkey", "l_linenumber").alias("span_id"), F.concat(F.lit("seq"), F.col("l_orderkey") % n).alias("contig"),
        (F.col("l_linenumber") * 40 + 1).cast("long").alias("start"), (F.col("l_linenumber") * 40 + 10 + F.col("q")).alias("end"))
    lens = V.dna(t).select(F.col("seq_id").alias("contig"), F.length("seq").alias("_n"))
    i = i.join(lens, "contig").where("_n > `end`").drop("_n")
    return Q.intron_strand(i, V.dna(t)).select("span_id", "motif", "strand")


@query("a1_assembly_stats", f"""with {V.SEQS} select count(*) as contigs, cast(sum(length(seq)) as bigint) as total, round(avg(length(seq)), 2) as mean,
 max(length(seq)) as longest, round(sum(length(seq) - length(regexp_replace(upper(seq), '[GCS]', '', 'g'))) * 100.0 / sum(length(seq)), 2) as gc from seqs""")
def _(t):
    return A.assembly_stats(V.seqs(t))


@query("a2_nx", """with l as (select n_chars as n from documents where n_chars > 0), c as (select n, sum(n) over (order by n desc, rowid) as cum from (select n, row_number() over () as rowid from l)),
 t as (select sum(n) as t from l), a as (select max(n) as n50 from c, t where cum >= t * 0.5), b as (select max(n) as n90 from c, t where cum >= t * 0.9)
 select n50, (select count(*) from l where n > n50) + 1 as l50, n90, (select count(*) from l where n > n90) + 1 as l90 from a, b""")
def _(t):
    return A.nx(t.documents.select(F.col("text").alias("seq")))


@query("a3_n50_weighted", """with l as (select n_chars as n from documents where n_chars > 0), g as (select n, sum(n) as w from l group by n),
 c as (select n, sum(w) over (order by n) as cum, sum(w) over () as t from g),
 a as (select min(n) filter (cum > t // 2) as hi, min(n) filter (cum > t // 2 - 1) as lo, max(t) as t from c)
 select case when t % 2 = 0 then (hi + lo) // 2 else hi end as n50 from a""")
def _(t):
    return A.n50_weighted(t.documents.select(F.col("text").alias("seq")))


@query("p1_assembly_qc", f"""with d as (select source || ' ' || doc_id as header, regexp_replace(text, '[^A-Za-z]', '', 'g') as seq from documents),
 c as (select header, upper(unnest(string_split(seq, ''))) as c from d where length(seq) > 0), g as (select header, c, count(*) as n from c where c <> '' group by 1, 2),
 a as (select header, string_agg(c || ':' || n, ',' order by c) filter (c not in ('A','C','G','T','R','Y','S','W','K','M','B','D','H','V','N')) as bad, count(*) as k from g group by 1)
 select d.header, length(d.header) > 8 as long_header, coalesce(bad, '') as non_iupac, cast(coalesce(k, 0) as int) as alphabet, coalesce(k, 0) < 4 as suspect from d left join a using (header)""")
def _(t):
    d = t.documents.select(F.concat_ws(" ", "source", "doc_id").alias("header"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"))
    return Q.assembly_qc(d, 8, "header")


@query("p2_filter_contigs", f"""with {V.SEQS} select seq_id, length(seq) as length, case when length(seq) >= 400 then 'keep' else 'candidate' end as role from seqs
 where length(seq) >= 50 and (select count(distinct upper(c)) from (select unnest(string_split(seq, '')) as c) where c <> '') >= 4""")
def _(t):
    return Q.filter_contigs(V.seqs(t), 400, 50)


@query("p5_clean_proteins", f"""with d as (select doc_id, case when doc_id % 3 = 0 then 'sp|' || source || '.' || lang when doc_id % 3 = 1 then 'jgi|x|' || source || ':' || lang
  else source || '/' || lang || ' d' || doc_id end as seq_id, text from documents where length(text) >= 200),
 b as (select doc_id, regexp_replace(case when regexp_matches(seq_id, '^(sp|jgi)\\|') then string_split(split_part(seq_id, ' ', 1), '|')[-1] else split_part(seq_id, ' ', 1) end, '[:;/\\\\.,%]', '_', 'g') as base from d),
 k as (select *, row_number() over (partition by base order by doc_id) - 1 as k from b) select doc_id, case when k = 0 then base else base || '_' || k end as new_id from k""")
def _(t):
    d = t.documents.select(
        "doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("sp|"), "source", F.lit("."), "lang"))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("jgi|x|"), "source", F.lit(":"), "lang"))
        .otherwise(F.concat("source", F.lit("/"), "lang", F.lit(" d"), "doc_id")).alias("seq_id"), F.col("text").alias("seq"))
    return Q.clean_proteins(d, 200, "doc_id").select("doc_id", "new_id")


@query("o1_sort_by_length", """select doc_id, row_number() over (order by n_chars desc, 'seq' || doc_id) as rank,
 'scaffold_' || row_number() over (order by n_chars desc, 'seq' || doc_id) as new_id from documents where n_chars >= 200""")
def _(t):
    s = t.documents.select("doc_id", F.concat(F.lit("seq"), "doc_id").alias("seq_id"), F.col("text").alias("seq"))
    return Q.sort_by_length(s, min_len=200).select("doc_id", "rank", "new_id")


@query("w6_rename_loci", """select name, 'GENE_' || printf('%06d', row_number() over (order by contig, "start", name)) as new_id from (select 'ctg' || (p_partkey % 10) as contig,
 p_size as "start", p_name || p_partkey as name from part)""")
def _(t):
    p = t.part.select(F.concat(F.lit("ctg"), F.col("p_partkey") % 10).alias("contig"), F.col("p_size").alias("start"),
                      F.concat("p_name", "p_partkey").alias("name"))
    return Q.rename_ids(p, ["contig", "start", "name"], "GENE_").select("name", "new_id")


@query("o7_longest_isoform", """select source as gene_id, 'seq' || doc_id as seq_id, n_chars from (select *, row_number() over (partition by source order by n_chars desc, doc_id) as k from documents) where k = 1""")
def _(t):
    s = t.documents.select(F.col("source").alias("gene_id"), F.concat(F.lit("seq"), "doc_id").alias("seq_id"), F.col("text").alias("seq"), F.col("doc_id").alias("ord"))
    return Q.longest_isoform(s).select("gene_id", "seq_id", F.length("seq").cast("long").alias("n_chars"))


@query("o12_ten_longest", """select 'seq' || doc_id as seq_id, n_chars as length from documents order by n_chars desc, 'seq' || doc_id limit 10""")
def _(t):
    return Q.longest(t.documents.select(F.concat(F.lit("seq"), "doc_id").alias("seq_id"), F.col("text").alias("seq")))


@query("o13_balanced_split", """select 'seq' || doc_id as seq_id, n_chars as length, row_number() over (order by n_chars desc, 'seq' || doc_id) as rank,
 (row_number() over (order by n_chars desc, 'seq' || doc_id) - 1) % 7 as chunk from documents""")
def _(t):
    return Q.balanced_split(t.documents.select(F.concat(F.lit("seq"), "doc_id").alias("seq_id"), F.col("text").alias("seq")), 7)


@query("o14_chunk_records", """select o_orderkey, cast(ntile(13) over (order by o_orderkey) as bigint) as chunk from orders""")
def _(t):
    return Q.chunk_records(t.orders.select("o_orderkey"), ["o_orderkey"], 13)


@query("a6_count_features", f"""with {V.IV} select source, strand, count(*) as n from iv group by rollup (source, strand)""")
def _(t):
    return A.count_features(V.iv(t), ["source", "strand"])


@query("a7_genome_summary", f"""with {V.SEQS}, l as (select length(seq) as n from seqs where length(seq) > 0), g as (select n, sum(n) as w from l group by n), c as (select n, sum(w) over (order by n) as cum, sum(w) over () as t from g),
 a as (select min(n) filter (cum > t // 2) as hi, min(n) filter (cum > t // 2 - 1) as lo, max(t) as t from c),
 s as (select count(*) as contigs, cast(sum(length(seq)) as bigint) as total, round(avg(length(seq)), 2) as mean, max(length(seq)) as longest,
 round(sum(length(seq) - length(regexp_replace(upper(seq), '[GCS]', '', 'g'))) * 100.0 / sum(length(seq)), 2) as gc from seqs)
 select s.*, case when t % 2 = 0 then (hi + lo) // 2 else hi end as n50, (select count(*) from part) as genes, (select count(*) from part where p_size % 5 > 0) as proteins,
 (select count(*) from part where p_size % 5 = 0) as trnas from s, a""")
def _(t):
    genes = t.part.select(F.when(F.col("p_size") % 5 > 0, "mRNA").otherwise("tRNA").alias("biotype"))
    return A.genome_summary(V.seqs(t), genes)


@query("a23_reads_per_transcript", """select o_orderkey as tx_id, count(l_orderkey) as n_reads from orders left join lineitem on l_orderkey = o_orderkey group by 1""")
def _(t):
    return A.reads_per_transcript(t.lineitem.select(F.col("l_orderkey").alias("tx_id")),
                                  t.orders.select(F.col("o_orderkey").alias("tx_id")))


@query("a4_annotation_summary", """with m as (select l_partkey % 500 as gene_id, case when l_quantity > 40 then 'tRNA' else 'mRNA' end as biotype, case when l_suppkey % 3 = 0 then 'nm' end as gene_name,
  cast(l_quantity as bigint) * 30 as length, l_linenumber as n_exons, l_tax > 0.04 as f, l_discount > 0.05 as h, l_returnflag = 'R' as ps, l_linestatus = 'O' as pe from lineitem), r as (select * from m where biotype = 'mRNA')
 select (select count(distinct gene_id) from m) as genes, (select count(distinct gene_id) from m where gene_name is not null) as common_name, count(*) as mrna,
 (select count(*) from m where biotype = 'tRNA') as trna, 0 as ncrna, 0 as rrna, round(avg(length), 2) as avg_length, cast(sum(n_exons) as bigint) as total_exons, round(avg(n_exons), 2) as avg_exons,
 count(*) filter (n_exons = 1) as single_exon, count(*) filter (n_exons > 1) as multiple_exon, count(*) filter (f and not h) as five_utr_only, count(*) filter (h and not f) as three_utr_only,
 count(*) filter (f and h) as both_utr, count(*) filter (not f and not h) as no_utr, count(*) filter (not ps and not pe) as complete, count(*) filter (ps and pe) as no_start_stop,
 count(*) filter (ps and not pe) as no_start, count(*) filter (not ps and pe) as no_stop from r""")
def _(t):
    m = t.lineitem.select(
        (F.col("l_partkey") % 500).alias("gene_id"), F.when(F.col("l_quantity") > 40, "tRNA").otherwise("mRNA").alias("biotype"),
        F.when(F.col("l_suppkey") % 3 == 0, "nm").alias("gene_name"), (F.col("l_quantity").cast("long") * 30).alias("length"),
        F.col("l_linenumber").alias("n_exons"), (F.col("l_tax") > 0.04).alias("five_utr"), (F.col("l_discount") > 0.05).alias("three_utr"),
        (F.col("l_returnflag") == "R").alias("partial_start"), (F.col("l_linestatus") == "O").alias("partial_stop"))
    return A.annotation_summary(m)


@query("a31_busco_summary", """with s as (select p_partkey as busco, count(l_partkey) filter (l_quantity > 46) as c, count(l_partkey) filter (l_quantity < 4) as f
  from part left join lineitem on l_partkey = p_partkey group by 1), k as (select count(*) as total, count(*) filter (c > 0) as complete, count(*) filter (c = 1) as single,
  count(*) filter (c > 1) as duplicated, count(*) filter (c = 0 and f > 0) as fragmented, count(*) filter (c = 0 and f = 0) as missing from s)
 select *, round(complete * 100.0 / total, 1) as complete_pct, round(single * 100.0 / total, 1) as single_pct, round(duplicated * 100.0 / total, 1) as duplicated_pct,
 round(fragmented * 100.0 / total, 1) as fragmented_pct, round(missing * 100.0 / total, 1) as missing_pct from k""")
def _(t):
    st = t.lineitem.select(F.col("l_partkey").alias("busco"), F.when(F.col("l_quantity") > 46, "Complete")
                           .when(F.col("l_quantity") < 4, "Fragmented").alias("status")).where("status is not null")
    return A.busco_summary(st, t.part.select(F.col("p_partkey").alias("busco")))


@query("a32_count_multi_cds", """with m as (select l_orderkey as tx_id, count(*) as n from lineitem group by 1), k as (select o_orderkey as tx_id from orders where o_orderstatus = 'F')
 select count(*) filter (n > 1) as multi, count(*) filter (n > 1 and tx_id in (select tx_id from k)) as multi_kept from m""")
def _(t):
    m = t.lineitem.groupBy(F.col("l_orderkey").alias("tx_id")).agg(F.count(F.lit(1)).alias("n_cds"))
    return A.count_multi_cds(m, t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("tx_id")))


FUNC = """fm as (select case when l_quantity > 40 then 'tRNA' else 'mRNA' end as biotype, l_suppkey % 4 = 0 as go, case when l_partkey % 3 = 0 then 'PFAM:' else 'InterPro:' end as x,
  (['EggNog:', 'CAZy:', 'MEROPS:', 'BUSCO:', 'SECRETED:', 'COG:', 'none'])[l_linenumber] as n, cast(l_quantity as bigint) as p from lineitem),
 fc as (select count(*) filter (go) as go_terms, count(*) filter (x = 'PFAM:') as pfam, count(*) filter (x = 'InterPro:') as interproscan, count(*) filter (n = 'EggNog:') as eggnog, count(*) filter (n = 'CAZy:') as cazyme,
  count(*) filter (n = 'MEROPS:') as merops, count(*) filter (n = 'BUSCO:') as busco, count(*) filter (n = 'SECRETED:') as secretion, round(avg(p), 2) as avg_protein_length from fm where biotype = 'mRNA')"""


def functional_models(t):
    notes = F.array(*[F.lit(x) for x in ("EggNog:", "CAZy:", "MEROPS:", "BUSCO:", "SECRETED:", "COG:", "none")])
    return t.lineitem.select(F.when(F.col("l_quantity") > 40, "tRNA").otherwise("mRNA").alias("biotype"), F.when(F.col("l_suppkey") % 4 == 0, F.array(F.lit("GO:1"))).alias("go"),
                             F.array(F.when(F.col("l_partkey") % 3 == 0, "PFAM:1").otherwise("InterPro:1")).alias("dbxrefs"),
                             F.array(F.lit("x"), F.element_at(notes, F.col("l_linenumber").cast("int"))).alias("notes"), F.col("l_quantity").cast("long").alias("protein_length"))


@query("a4_functional_counts", f"""with {FUNC} select * from fc""")
def _(t):
    return A.functional_counts(functional_models(t))


@query("k12_stats_document", f"""with {FUNC}, o as (select count(*) as rows, count(distinct l_suppkey) as contigs from lineitem)
 select cast(to_json({{'format': {{'rows': rows, 'contigs': contigs}}, 'annotation': {{'functional': {{'go_terms': go_terms, 'pfam': pfam, 'busco': busco}}}}}}) as varchar) as json from fc, o""")
def _(t):
    from ..sinks import text as K
    counts = t.lineitem.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("l_suppkey").alias("contigs"))
    return K.stats_document(format=counts, annotation={"functional": A.functional_counts(functional_models(t)).select("go_terms", "pfam", "busco")})
