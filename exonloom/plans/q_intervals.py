"""Registered interval queries."""

from pyspark.sql import functions as F

from ..operators import intervals as I
from . import views as V
from .registry import query

ISL = """spans as (select contig, "start", max("end") as "end", count(*) as n from {src} group by 1, 2),
 fl as (select *, case when "start" {cmp} max("end") over (partition by contig order by "start"
   rows between unbounded preceding and 1 preceding) then 0 else 1 end as f from spans),
 isl as (select *, sum(f) over (partition by contig order by "start" rows unbounded preceding) as g from fl),
 merged as (select contig, cast(g as bigint) as g, min("start") as "start", max("end") as "end", cast(sum(n) as bigint) as n from isl group by 1, 2)"""


@query("j1_overlap_join", f"""with {V.IV}, {V.MASK} select i.name, m.name as mask_name, i.contig, i."start", i."end",
 m."start" as m_start, m."end" as m_end from iv i join mask m
 on i.contig = m.contig and i."start" <= m."end" and i."end" >= m."start" """)
def _(t):
    j = I.overlap_join(V.iv(t), V.mask(t))
    return j.select("name", F.col("b_name").alias("mask_name"), "contig", "start", "end",
                    F.col("b_start").alias("m_start"), F.col("b_end").alias("m_end"))


@query("j2_overlap_semi", f"""with {V.IV}, {V.MASK} select * from iv i where exists (select 1 from mask m
 where i.contig = m.contig and i."start" <= m."end" and i."end" >= m."start")""")
def _(t):
    return I.overlap_semi(V.iv(t), V.mask(t))


@query("j2_overlap_anti", f"""with {V.IV}, {V.MASK} select * from iv i where not exists (select 1 from mask m
 where i.contig = m.contig and i."start" <= m."end" and i."end" >= m."start")""")
def _(t):
    return I.overlap_anti(V.iv(t), V.mask(t))


@query("j3_overlap_fraction", f"""with {V.IV}, {V.MASK} select * from iv i where exists (select 1 from mask m
 where i.contig = m.contig and i."start" <= m."end" and i."end" >= m."start"
 and least(i."end", m."end") - greatest(i."start", m."start") + 1 >= 0.9 * (i."end" - i."start" + 1))""")
def _(t):
    return I.overlap_fraction(V.iv(t), V.mask(t), 0.9)


@query("j3_repeat_genes_per_contig", f"""with {V.IV}, {V.MASK} select contig, count(distinct name) as n_masked from iv i
 where exists (select 1 from mask m where i.contig = m.contig and i."start" <= m."end" and i."end" >= m."start"
 and least(i."end", m."end") - greatest(i."start", m."start") + 1 >= 0.9 * (i."end" - i."start" + 1)) group by contig""")
def _(t):
    return (I.overlap_fraction(V.iv(t), V.mask(t), 0.9).groupBy("contig")
            .agg(F.count_distinct("name").alias("n_masked")))


@query("j4_closest_join", f"""with {V.IV}, {V.MASK}, sp as (select distinct contig, "start", "end" from iv),
 d as (select s.*, m.name as mask_name, case when s."start" <= m."end" and s."end" >= m."start" then 0
   else greatest(m."start" - s."end", s."start" - m."end") end as distance from sp s join mask m using (contig)),
 b as (select *, min(distance) over (partition by contig, "start", "end") as md from d)
 select contig, "start", "end", mask_name, distance from b where distance = md""")
def _(t):
    return I.closest_spans(V.iv(t), V.mask(t)).select(
        "contig", "start", "end", F.col("b_name").alias("mask_name"), "distance")


@query("j5_best_overlap_join", f"""with {V.IV}, nw as (select * from iv where source = 'N'), od as (select * from iv where source = 'R'),
 p as (select n.name, o.name as old_name, abs(n."start" - o."start") + abs(n."end" - o."end") as shift,
 row_number() over (partition by n.contig, n."start", n."end", n.name order by abs(n."start" - o."start") + abs(n."end" - o."end"), o.name) as k
 from nw n join od o on n.contig = o.contig and n."start" <= o."end" and n."end" >= o."start")
 select distinct name, old_name, shift from p where k = 1""")
def _(t):
    f = V.iv(t)
    out = I.best_overlap_join(f.where("source = 'N'"), f.where("source = 'R'"))
    return out.select("name", "old_name", "shift").distinct()


@query("j6_drop_contained", f"""with {V.IV}, best as (select contig, strand, "start", "end", score, name from (select *,
 row_number() over (partition by contig, strand, "start", "end" order by score desc, name desc) as k from iv) where k = 1)
 select distinct i.contig, i.strand, i."start", i."end", i.name from iv i join best b on i.name = b.name and i.contig = b.contig and i.strand = b.strand
 and i."start" = b."start" and i."end" = b."end" where not exists (select 1 from best o where o.contig = b.contig and o.strand = b.strand
 and o."start" <= b."start" and o."end" >= b."end" and (o."start" <> b."start" or o."end" <> b."end"))""")
def _(t):
    return I.drop_contained(V.iv(t)).select("contig", "strand", "start", "end", "name").distinct()


@query("j7_assign_clusters", f"""with {V.IV}, {V.MASK}, p as (select i.contig, i."start", i."end", m.name as cluster,
 row_number() over (partition by i.contig, i."start", i."end" order by m."start", m."end", m.name) as k
 from (select distinct contig, "start", "end" from iv) i join mask m
 on i.contig = m.contig and i."start" <= m."end" and i."end" >= m."start")
 select i.name, p.cluster from iv i join p using (contig, "start", "end") where k = 1""")
def _(t):
    return I.assign_clusters(V.iv(t), V.mask(t)).select("name", "cluster")


@query("a25_merge_intervals", f"""with {V.IV}, {ISL.format(src='iv', cmp='<')} select contig, "start", "end" from merged""")
def _(t):
    return I.merge_intervals(V.iv(t))


@query("a25_merge_touching", f"""with {V.MASK}, {ISL.format(src='mask', cmp='<=')} select contig, "start", "end" from merged""")
def _(t):
    return I.merge_intervals(V.mask(t), touching=True)


@query("a26_covered_length", f"""with {V.IV}, {ISL.format(src='iv', cmp='<=')}
 select contig, cast(sum("end" - "start" + 1) as bigint) as covered from merged group by contig""")
def _(t):
    return I.covered_length(V.iv(t))


@query("a26_shared_length", f"""with {V.IV}, {V.MASK},
 a as (select distinct contig, unnest(range("start", "end" + 1)) as p from iv),
 b as (select distinct contig, unnest(range("start", "end" + 1)) as p from mask)
 select c.contig, count(a.p) as shared from (select contig from a union select contig from b) c
 left join (select a.contig, a.p from a join b using (contig, p)) a on a.contig = c.contig group by 1""")
def _(t):
    return I.shared_length(V.iv(t), V.mask(t))


@query("w2_islands", f"""with {V.IV}, {ISL.format(src='iv', cmp='<')}
 select contig, g as island, "start" as isl_start, "end" as isl_end, n as members from merged""")
def _(t):
    return I.islands(V.iv(t))


@query("w5_loci_with_gaps", f"""with {V.MASK}, {ISL.format(src='mask', cmp='<=')}
 select contig, "start", "end", "start" - lag("end") over (partition by contig order by "start") as gap,
 row_number() over (partition by contig order by "start") as locus_no from merged""")
def _(t):
    return I.loci_with_gaps(V.mask(t))


PARTS = """loci as (select contig, "start", "end", "start" - lag("end") over w as gap, lag("end") over w as prev,
   row_number() over w - 1 as idx, count(*) over (partition by contig) as n from merged window w as (partition by contig order by "start")),
 tot as (select contig, max(n) as n, max("end") + 500 as length, case when max(n) > 5 and max(gap) >= 45 then cast(ceil(max(n) / 5.0) as bigint) else 1 end as chunks
   from loci group by 1),
 st as (select *, cast(round_even(n / chunks, 0) as bigint) as step from tot),
 tgt as (select l.contig, l.idx // s.step as part, l.idx from loci l join st s using (contig)
   where l.idx > 0 and l.idx % s.step = 0 and l.idx // s.step < s.chunks),
 cut as (select t.contig, t.part, (select l.idx from loci l where l.contig = t.contig and l.gap >= 45
   order by case when l.idx <= t.idx then 0 else 1 end, abs(l.idx - t.idx) limit 1) as cidx from tgt t),
 cc as (select c.contig, c.part, l."start" as cs, l.prev from cut c join loci l on l.contig = c.contig and l.idx = c.cidx),
 pp as (select contig, n, length, chunks, unnest(range(1, chunks + 1)) as part from st),
 sp as (select p.contig, p.part, p.n as n_loci, chunks, case when p.part = 1 then 1 else o.prev + 1 end as "start",
   case when p.part = chunks or c.cs is null then length else c.cs - 1 end as "end"
   from pp p left join cc c on c.contig = p.contig and c.part = p.part
   left join cc o on o.contig = p.contig and o.part = p.part - 1)"""


def _parts(t):
    m = V.mask(t)
    lengths = m.groupBy("contig").agg((F.max("end") + 500).alias("length"))
    return I.partition_spans(m, lengths, per_part=5, min_gap=45, min_span=60)


@query("w11_partition_loci", f"""with {V.MASK}, {ISL.format(src='mask', cmp='<=')}, {PARTS}
 select contig, part, "start", "end", n_loci from sp where (chunks = 1 or "end" - "start" >= 60) and "start" is not null""")
def _(t):
    return _parts(t)


@query("w12_slice_partition", f"""with {V.IV}, {V.MASK}, {ISL.format(src='mask', cmp='<=')}, {PARTS},
 q as (select * from sp where (chunks = 1 or "end" - "start" >= 60) and "start" is not null)
 select i.name, i.contig, q.part, i."start" - q."start" + 1 as "start", i."end" - q."start" + 1 as "end"
 from iv i join q on i.contig = q.contig and i."start" >= q."start" and i."end" <= q."end" """)
def _(t):
    return I.slice_partition(V.iv(t), _parts(t)).select("name", "contig", "part", "start", "end")


@query("w13_chunk_contigs", """with l as (select 'seq' || doc_id as contig, n_chars as length from documents),
 n as (select *, case when length > 2000 then length // 2000 + 1 else 1 end as k from l),
 c as (select contig, length, k, length // k as step, unnest(range(1, k + 1)) as chunk from n)
 select contig, length, chunk, greatest((chunk - 1) * step, 1) as "start",
 case when chunk = k then length else least(chunk * step + 100, length) end as "end" from c""")
def _(t):
    lengths = t.documents.select(F.concat(F.lit("seq"), "doc_id").alias("contig"), F.col("n_chars").alias("length"))
    return I.chunk_spans(lengths, 2000, 100)


@query("w14_renumber_clusters", """with d as (select distinct 'ctg' || l_suppkey as contig, l_partkey as n from lineitem),
 f as (select *, case when n - lag(n) over w = 1 then 0 else 1 end as f from d window w as (partition by contig order by n))
 select contig, n, cast(sum(f) over (partition by contig order by n rows unbounded preceding) as bigint) as cluster from f""")
def _(t):
    d = t.lineitem.select(F.concat(F.lit("ctg"), "l_suppkey").alias("contig"), F.col("l_partkey").alias("n")).distinct()
    return I.renumber_clusters(d)


@query("a24_collapse_hits", """select l_partkey as query, l_suppkey as subject, min(l_orderkey) as "start",
 max(l_orderkey + l_linenumber) as "end", count(*) as n_rows from lineitem group by 1, 2""")
def _(t):
    h = t.lineitem.select(F.col("l_partkey").alias("query"), F.col("l_suppkey").alias("subject"),
                          F.col("l_orderkey").alias("start"), (F.col("l_orderkey") + F.col("l_linenumber")).alias("end"))
    return I.collapse_spans(h, ["query", "subject"])


@query("a37_model_spans", f"""with {V.TX} select gene_id, min("start") as "start", max("end") as "end", count(*) as n_rows from tx group by 1""")
def _(t):
    return I.collapse_spans(V.tx(t), ["gene_id"])
