"""Registered hit-selection queries."""

from pyspark.sql import functions as F

from ..operators import hits as H
from . import views as V
from .registry import query

ROW = "hit_id, hit_no, subject, evalue, bitscore, pident, tax, flag"


@query("o4_best_hit", f"""with {V.HITS} select query, subject, evalue, bitscore, hit_id, hit_no from (select *, row_number() over
 (partition by query order by evalue, bitscore desc, subject, hit_id, hit_no) as k from hits) where k = 1""")
def _(t):
    out = H.best_hit(V.hits(t), order=["evalue", -F.col("bitscore"), "subject", "hit_id", "hit_no"])
    return out.select("query", "subject", "evalue", "bitscore", "hit_id", "hit_no")


@query("o5_top_hits", f"""with {V.HITS} select query, subject, pident, cast(k as int) as rank from (select *, row_number() over
 (partition by query order by pident desc, bitscore desc, hit_id, hit_no) as k from hits) where k <= 3""")
def _(t):
    out = H.top_hits(V.hits(t), 3, order=[F.col("pident").desc(), F.col("bitscore").desc(), "hit_id", "hit_no"])
    return out.select("query", "subject", "pident", "rank")


SP = """sp as (select l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey as query, cast(l_quantity as bigint) as n_ident, 50 as aln_len, l_linenumber + 49 as qlen,
 p_name || case when p_size % 4 = 0 then ' (Fragment)' when p_size % 4 = 1 then ' homolog,' else '' end || ' protein OS=Genus species GN=' || substr(p_name, 1, 2) || case when p_size % 5 = 0 then '_' when p_size % 5 = 1 then '-' else '' end || p_size || ' PE=1' as description
 from lineitem join part on l_partkey = p_partkey)"""


def sp_hits(t):
    p = F.col("p_size")
    descr = F.concat("p_name", F.when(p % 4 == 0, " (Fragment)").when(p % 4 == 1, " homolog,").otherwise(""), F.lit(" protein OS=Genus species GN="),
                     F.substring("p_name", 1, 2), F.when(p % 5 == 0, "_").when(p % 5 == 1, "-").otherwise(""), p, F.lit(" PE=1"))
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("query"), F.col("l_quantity").cast("long").alias("n_ident"),
                    F.lit(50).alias("aln_len"), (F.col("l_linenumber") + 49).alias("qlen"), descr.alias("description"))


NAME = "replace(upper(split_part(string_split(description, 'GN=')[-1], ' ', 1)), '-', '')"
PROD = "array_to_string(list_filter(string_split(split_part(description, ' OS=', 1), ' '), lambda w: w not in ('(Fragment)', 'homolog', 'homolog,', 'AltName:')), ' ')"
DIG = "length(regexp_replace({c}, '[^0-9]', '', 'g'))"
VALID = "not regexp_matches({c}, '[_ .]') and length({c}) > 2 and " + DIG + " between 1 and 2"


@query("p7_filter_homologs", f"""with {SP}, n as (select query, {NAME} as name, {PROD} as product from sp where n_ident / aln_len >= 0.6 and aln_len / qlen >= 0.6)
 select * from n where {VALID.format(c='name')}""")
def _(t):
    return H.filter_homologs(sp_hits(t)).select("query", "name", "product")


@query("f19_swissprot_fields", f"""with {SP} select query, {NAME} as name, {PROD} as product from sp""")
def _(t):
    from ..functions import naming as N
    return sp_hits(t).select("query", N.swissprot_symbol(F.col("description")).alias("name"), N.swissprot_product(F.col("description")).alias("product"))


@query("p8_valid_symbol", f"""with s as (select p_partkey, replace(p_name, ' ', case when p_size % 3 = 0 then '_' else '' end) || p_size || case when p_size % 7 = 0 then '.1' else '' end as symbol from part)
 select p_partkey, symbol, {VALID.format(c='symbol')} as valid from s""")
def _(t):
    from ..functions import naming as N
    s = F.concat(F.when(F.col("p_size") % 3 == 0, F.replace("p_name", F.lit(" "), F.lit("_"))).otherwise(F.replace("p_name", F.lit(" "), F.lit(""))),
                 "p_size", F.when(F.col("p_size") % 7 == 0, ".1").otherwise(""))
    return t.part.select("p_partkey", s.alias("symbol")).withColumn("valid", N.valid_symbol(F.col("symbol")))


DOM = """dom as (select 'p' || l_orderkey as query, 'PF' || l_partkey || '.' || l_linenumber as accession, case when l_suppkey % 2 = 0 then 'GH' || l_suppkey || '_' || l_linenumber else 'AA' || l_suppkey end as family,
 l_linenumber as hmm_start, l_linenumber + cast(l_quantity as bigint) as hmm_end, 50 as hmm_len, l_discount * 1e-16 as evalue from lineitem)"""


def domains(t):
    return t.lineitem.select(
        F.concat(F.lit("p"), "l_orderkey").alias("query"), F.concat(F.lit("PF"), "l_partkey", F.lit("."), "l_linenumber").alias("accession"),
        F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("GH"), "l_suppkey", F.lit("_"), "l_linenumber")).otherwise(F.concat(F.lit("AA"), "l_suppkey")).alias("family"),
        F.col("l_linenumber").alias("hmm_start"), (F.col("l_linenumber") + F.col("l_quantity").cast("long")).alias("hmm_end"), F.lit(50).alias("hmm_len"),
        (F.col("l_discount") * 1e-16).alias("evalue"))


@query("p9_filter_pfam", f"""with {DOM} select query as id, 'db_xref' as ref_db, 'PFAM:' || split_part(accession, '.', 1) as value from dom where (hmm_end - hmm_start) / hmm_len >= 0.5""")
def _(t):
    return H.filter_pfam(domains(t))


@query("p10_filter_cazy", f"""with {DOM} select distinct query as id, 'note' as ref_db, 'CAZy:' || regexp_replace(family, '_[^_]*$', '') as value from dom
 where (hmm_end - hmm_start) / hmm_len >= 0.35 and evalue <= 3e-18""")
def _(t):
    return H.filter_cazy(domains(t), 3e-18)


@query("p11_filter_merops", f"""with {V.HITS}, b as (select query, min(evalue) as e from hits group by 1), s as (select h.query, h.subject, row_number() over (partition by h.query order by bitscore desc, subject) as k
 from hits h join b on h.query = b.query and h.evalue = b.e where b.e <= 1e-5) select query as id, 'note' as ref_db, 'MEROPS:MER' || subject as value from s where k = 1""")
def _(t):
    return H.filter_merops(V.hits(t).withColumn("subject", F.concat(F.lit("MER"), "subject"))
                           .withColumn("bitscore", F.col("bitscore")))


@query("j19_expand_hits", """with h as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber as sstart, l_linenumber + 20 as send, 30 + l_linenumber as slen,
  l_partkey as a, l_partkey + 60 as b, case when l_linestatus = 'O' then 1 else -1 end as qframe, 1900 as qlen from lineitem),
 o as (select *, case when qframe > 0 then a else b end as qstart, case when qframe > 0 then b else a end as qend from h),
 x as (select *, case when qframe > 0 then qstart - (sstart * 3 - 3) else qend - (slen - send) * 3 end as s0, case when qframe > 0 then qend + (slen - send) * 3 else qstart + (sstart * 3 - 3) end as e0 from o)
 select l_orderkey, l_linenumber, l_partkey, l_suppkey, qframe, cast(greatest(s0, 1) as bigint) as "start", cast(least(e0, qlen) as bigint) as "end" from x where least(e0, qlen) > greatest(s0, 1)""")
def _(t):
    plus = F.col("l_linestatus") == "O"
    h = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_linenumber").alias("sstart"), (F.col("l_linenumber") + 20).alias("send"), (F.col("l_linenumber") + 30).alias("slen"),
        F.when(plus, F.col("l_partkey")).otherwise(F.col("l_partkey") + 60).alias("qstart"), F.when(plus, F.col("l_partkey") + 60).otherwise(F.col("l_partkey")).alias("qend"),
        F.when(plus, 1).otherwise(-1).alias("qframe"), F.lit(1900).alias("qlen"))
    return H.expand_hits(h).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "qframe", "start", "end")


PAF = """paf as (select 'r' || l_partkey as query, case when l_suppkey % 40 = 0 then '*' else 'c' || l_suppkey end as target, cast(l_discount * 2.5 as double) as de, l_linenumber as mapq from lineitem)"""


def paf(t):
    return t.lineitem.select(
        F.concat(F.lit("r"), "l_partkey").alias("query"), F.when(F.col("l_suppkey") % 40 == 0, "*").otherwise(F.concat(F.lit("c"), "l_suppkey")).alias("target"),
        (F.col("l_discount") * 2.5).alias("de"), F.col("l_linenumber").alias("mapq"))


@query("p22_reads_not_in", f"""with {PAF} select distinct query from paf where target = '*' or 100 - de * 100 < 80 or 100 - de * 100 = 0""")
def _(t):
    return H.reads_not_in(paf(t))


@query("p22_reads_mapped", f"""with {PAF} select distinct query from paf where mapq > 2""")
def _(t):
    return H.reads_mapped(paf(t))


@query("p22_split_by_flag", """select l_orderkey, l_linenumber, l_partkey % 32 as flag, (l_partkey % 32) & 4 <> 0 as unmapped from lineitem""")
def _(t):
    return H.split_by_flag(t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 32).alias("flag")))


@query("j18_reciprocal_best_hits", """with h as (select 'S' || (l_partkey % 5) as q_species, 'g' || l_partkey as query, 'S' || (p2 % 5) as s_species, 'g' || p2 as subject, l_discount * 1e-4 as evalue, l_extendedprice as bitscore
  from (select *, l_partkey + l_linenumber + cast(l_quantity as bigint) % 3 - 5 as p2 from lineitem) where p2 >= 0),
 g as (select * from h where evalue <= 1e-5 and q_species <> s_species),
 b as (select q_species, query, s_species, subject from (select *, row_number() over (partition by q_species, query, s_species order by evalue, bitscore desc, subject) as k from g) where k = 1)
 select x.* from b x join b y on x.q_species = y.s_species and x.s_species = y.q_species and x.query = y.subject and x.subject = y.query where (x.q_species, x.query) < (x.s_species, x.subject)""")
def _(t):
    p2 = F.col("l_partkey") + F.col("l_linenumber") + F.col("l_quantity").cast("long") % 3 - 5
    h = t.lineitem.withColumn("p2", p2).where("p2 >= 0").select(
        F.concat(F.lit("S"), F.col("l_partkey") % 5).alias("q_species"), F.concat(F.lit("g"), "l_partkey").alias("query"),
        F.concat(F.lit("S"), F.col("p2") % 5).alias("s_species"), F.concat(F.lit("g"), "p2").alias("subject"),
        (F.col("l_discount") * 1e-4).alias("evalue"), F.col("l_extendedprice").alias("bitscore"))
    return H.reciprocal_best_hits(h)


BUS = """bh as (select 'B' || l_suppkey as busco, 'g' || l_partkey as gene, l_linenumber * 10 as hs, l_linenumber * 10 + cast(l_quantity as bigint) as he, l_extendedprice as score from lineitem),
 ok as (select * from bh where score >= 20000),
 cov as (select busco, gene, count(distinct p) as covered from (select busco, gene, unnest(range(hs, he + 1)) as p from ok) group by 1, 2),
 m as (select c.*, o.score, (40.0 + cast(substr(c.busco, 2) as bigint) % 7 - covered) / 6.0 as sigma from cov c join (select busco, gene, max(score) as score from ok group by 1, 2) o using (busco, gene)),
 cl as (select *, case when sigma between -2 and 2 then 'complete' when sigma > 2 then 'fragment' else 'large' end as class from m)"""


def busco_classed(t):
    bh = t.lineitem.select(
        F.concat(F.lit("B"), "l_suppkey").alias("busco"), F.concat(F.lit("g"), "l_partkey").alias("gene"), (F.col("l_linenumber") * 10).cast("long").alias("hmm_start"),
        (F.col("l_linenumber") * 10 + F.col("l_quantity").cast("long")).alias("hmm_end"), F.col("l_extendedprice").alias("score"))
    cut = t.supplier.select(F.concat(F.lit("B"), "s_suppkey").alias("busco"), F.lit(20000.0).alias("min_score"),
                            (F.col("s_suppkey") % 7 + 40.0).alias("mean_len"), F.lit(6.0).alias("sigma_len"))
    return H.measure_busco(bh, cut)


@query("p26_classify_busco", f"""with {BUS} select busco, gene, covered, score, round(sigma, 6) as sigma, class from cl""")
def _(t):
    return busco_classed(t).select("busco", "gene", "covered", "score", F.round("sigma", 6).alias("sigma"), "class")


@query("o8_resolve_busco", f"""with {BUS}, k as (select *, row_number() over (partition by class, gene order by score desc, busco desc) as r from cl where class <> 'fragment'),
 o as (select *, max(score) over (partition by class, busco) * 0.85 as cut from k where r = 1), kept as (select * from o where score >= cut),
 fin as (select * from kept where class = 'complete' union all select * from kept where class = 'large' and busco not in (select busco from kept where class = 'complete')),
 f2 as (select busco, gene, score, case when count(*) over (partition by busco) > 1 then 'Duplicated' else 'Complete' end as status from fin),
 fr as (select busco, gene, score, 'Fragmented' as status from (select *, row_number() over (partition by busco order by score desc, gene desc) as r2 from cl where class = 'fragment' and busco not in (select busco from fin)) where r2 = 1)
 select * from f2 union all select * from fr""")
def _(t):
    return H.resolve_busco(busco_classed(t))


@query("p28_busco_notes", """select 'g' || l_partkey as id, 'note' as ref_db, 'BUSCO:B' || l_suppkey as value from lineitem where l_returnflag in ('A', 'R')""")
def _(t):
    st = F.when(F.col("l_returnflag") == "A", "Complete").when(F.col("l_returnflag") == "R", "Duplicated").otherwise("Missing")
    return H.busco_notes(t.lineitem.select(F.concat(F.lit("g"), "l_partkey").alias("gene"), F.concat(F.lit("B"), "l_suppkey").alias("busco"), st.alias("status")))


@query("o9_busco_regions", """with b as (select 'B' || (l_partkey % 300) as busco, 'c' || l_suppkey as contig, l_partkey as s, l_partkey + cast(l_quantity as bigint) as e, l_extendedprice as score from lineitem where l_returnflag = 'A'),
 k as (select *, row_number() over (partition by busco order by score desc, contig desc, s desc, e desc) as r from b)
 select busco, contig, greatest(s - 100, 1) as "start", least(e + 100, 1990 + s_suppkey % 10) as "end", score from k join supplier on contig = 'c' || s_suppkey where r = 1""")
def _(t):
    b = t.lineitem.select(
        F.concat(F.lit("B"), F.col("l_partkey") % 300).alias("busco"), F.concat(F.lit("c"), "l_suppkey").alias("contig"), F.col("l_partkey").alias("start"),
        (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("end"), F.col("l_extendedprice").alias("score"), F.expr("case l_returnflag when 'A' then 'Complete' when 'R' then 'Duplicated' else 'Missing' end").alias("status"))
    sizes = t.supplier.select(F.concat(F.lit("c"), "s_suppkey").alias("contig"), (F.col("s_suppkey") % 10 + 1990).alias("length"))
    return H.busco_regions(b, sizes).select("busco", "contig", "start", "end", "score")


@query("a38_candidate_regions", """with h as (select 'q' || (l_orderkey % 200) as query, 'c' || (l_suppkey % 20) as contig, l_partkey * 40 as s, l_partkey * 40 + 30 as e, l_linenumber * 20 as qs, l_linenumber * 20 + cast(l_quantity as bigint) as qe, l_discount as evalue from lineitem),
 sp as (select query, contig, s, max(e) as e from h group by 1, 2, 3),
 f as (select *, case when s <= max(e) over (partition by query, contig order by s rows between unbounded preceding and 1 preceding) + 400 then 0 else 1 end as f from sp),
 i as (select *, sum(f) over (partition by query, contig order by s rows unbounded preceding) as isl from f),
 m as (select h.*, i.isl from h join i using (query, contig, s)),
 g as (select query, contig, isl, min(s) as s, max(e) as e, min(evalue) as evalue from m group by 1, 2, 3),
 c as (select query, contig, isl, count(distinct p) as covered from (select query, contig, isl, unnest(range(qs, qe + 1)) as p from m) group by 1, 2, 3),
 t as (select *, max(covered) over (partition by query) as top from g join c using (query, contig, isl)),
 r as (select *, row_number() over (partition by query order by covered desc, evalue, contig, s) as k from t where covered >= top * 0.7)
 select query, contig, greatest(s - 50, 1) as "start", e + 50 as "end", covered, cast(k as int) as rank from r where k <= 3""")
def _(t):
    h = t.lineitem.select(
        F.concat(F.lit("q"), F.col("l_orderkey") % 200).alias("query"), F.concat(F.lit("c"), F.col("l_suppkey") % 20).alias("contig"), (F.col("l_partkey") * 40).alias("start"),
        (F.col("l_partkey") * 40 + 30).alias("end"), (F.col("l_linenumber") * 20).cast("long").alias("q_start"),
        (F.col("l_linenumber") * 20 + F.col("l_quantity").cast("long")).alias("q_end"), F.col("l_discount").alias("evalue"))
    return H.candidate_regions(h, 3, 50, 400).select("query", "contig", "start", "end", "covered", "rank")


@query("j23_drop_redundant", """with m as (select o_orderkey as tx_id, count(l_orderkey) as n_exons from orders left join lineitem on l_orderkey = o_orderkey group by 1),
 e as (select l_orderkey as a, l_partkey % 3000 as b from lineitem where l_quantity * 2 >= 80 and l_orderkey <> l_partkey % 3000), s as (select a, b from e union select b, a from e)
 select m.* from m where tx_id not in (select a from s join m x on x.tx_id = a join m y on y.tx_id = b where y.n_exons > x.n_exons or (y.n_exons = x.n_exons and y.tx_id < x.tx_id))""")
def _(t):
    n = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_exons"))
    m = t.orders.join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderkey").alias("tx_id"), F.coalesce("n_exons", F.lit(0).cast("long")).alias("n_exons"))
    h = t.lineitem.select(F.col("l_orderkey").alias("query"), (F.col("l_partkey") % 3000).alias("subject"), (F.col("l_quantity") * 2).alias("pident"))
    return H.drop_redundant(m, h)


@query("j22_dedup_contained")
def _(t):
    return H.dedup_contained(V.dna(t))


@query("j16_intron_support", f"""with i as (select l_orderkey as tx_id, 'ctg' || (l_suppkey % 3) as contig, l_linestatus as strand, l_partkey % 40 as s, l_partkey % 40 + l_linenumber as e from lineitem),
 h as (select distinct 'ctg' || (l_suppkey % 3) as contig, l_linestatus as strand, l_partkey % 40 as s, l_partkey % 40 + l_linenumber as e from lineitem where l_quantity > 47)
 select tx_id, count(*) as n_introns, count(h.s) as n_supported, bool_and(h.s is not null) as good from i left join h using (contig, strand, s, e) group by 1""")
def _(t):
    i = t.lineitem.select(F.col("l_orderkey").alias("tx_id"), F.concat(F.lit("ctg"), F.col("l_suppkey") % 3).alias("contig"), F.col("l_linestatus").alias("strand"),
                          (F.col("l_partkey") % 40).alias("start"), (F.col("l_partkey") % 40 + F.col("l_linenumber")).alias("end"), "l_quantity")
    return H.intron_support(i, i.where("l_quantity > 47"))


@query("a5_evidence_support", f"""with {V.IV}, {V.MASK} select count(*) as n_exons, count(*) filter (ok) as n_supported, round(count(*) filter (ok) * 100.0 / count(*), 2) as pct from (select exists (select 1 from mask m
 where i.contig = m.contig and i."start" <= m."end" and i."end" >= m."start" and least(i."end", m."end") - greatest(i."start", m."start") + 1 >= 0.9 * (i."end" - i."start" + 1)) as ok from iv i)""")
def _(t):
    return H.evidence_support(V.iv(t), V.mask(t))


@query("j24_name_by_region", """with m as (select l_orderkey, l_linenumber, l_partkey, 'c' || (l_suppkey % 10) as contig, l_partkey as s, l_partkey + cast(l_quantity as bigint) as e, l_suppkey from lineitem),
 h as (select contig, s, e, min('B' || l_suppkey) as busco from m where l_linenumber = 1 group by 1, 2, 3)
 select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(busco, 'unknown_model') as busco from m left join h using (contig, s, e)""")
def _(t):
    m = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat(F.lit("c"), F.col("l_suppkey") % 10).alias("contig"), F.col("l_partkey").alias("start"),
                          (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("end"))
    h = m.where("l_linenumber = 1").withColumn("busco", F.concat(F.lit("B"), "l_suppkey"))
    return H.name_by_region(m, h).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "busco")
