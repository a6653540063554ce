"""Registered comparative, graph and diff queries."""

from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import comparative as C
from ..operators import diff as D
from ..operators import graph as G
from . import views as V
from .registry import query

CNT = "cnt as (select species, family, count(*) as n from fam group by 1, 2)"


def cnt(t):
    return C.family_counts(V.fam(t))


@query("a8_family_counts", f"with {V.FAM} select species, family, count(*) as n from fam group by 1, 2")
def _(t):
    return C.family_counts(V.fam(t))


@query("a8_dense_counts", f"""with {V.FAM}, {CNT}, s as (select distinct species from cnt), f as (select distinct family from cnt)
 select s.species, f.family, coalesce(n, 0) as n from s cross join f left join cnt using (species, family)""")
def _(t):
    return C.dense_counts(cnt(t))


@query("a9_class_counts", f"""with {V.FAM}, c as (select species, (['A01', 'C12', 'GH5', 'M3', 'ZZ1', 'S9'])[cast(substr(family, 7) as int) % 6 + 1] as family, count(*) as n from fam group by 1, 2)
 select species, regexp_extract(family, '^[A-Z]+') as class, cast(sum(n) as bigint) as n from c where regexp_extract(family, '^[A-Z]+') in ('A', 'C', 'G', 'M', 'N', 'P', 'S', 'T', 'U', 'I') group by 1, 2""")
def _(t):
    arr = F.array(*[F.lit(x) for x in ("A01", "C12", "GH5", "M3", "ZZ1", "S9")])
    f = V.fam(t).withColumn("family", F.get(arr, F.substring("family", 7, 5).cast("int") % 6))
    return C.class_counts(C.family_counts(f), C.MEROPS_CLASSES)


@query("a10_percent_of_species", f"with {V.FAM}, {CNT} select species, family, n, round(n * 100.0 / sum(n) over (partition by species), 6) as pct from cnt")
def _(t):
    return C.percent_of_species(cnt(t)).withColumn("pct", F.round("pct", 6))


@query("a11_drop_empty", f"""with {V.FAM}, z as (select species, family, sum(case when qty > 49 and species < 'NATION_14' then 1 else 0 end) as n from fam group by 1, 2)
 select species, family, cast(n as bigint) as n from z where species in (select species from z group by 1 having sum(n) > 0)""")
def _(t):
    z = V.fam(t).groupBy("species", "family").agg(F.sum(F.when(F.expr("qty > 49 and species < 'NATION_14'"), 1).otherwise(0)).alias("n"))
    return C.drop_empty(z, "species")


@query("a12_variable_families", f"""with {V.FAM}, {CNT}, g as (select f.family, coalesce(n, 0) as n from (select distinct species from cnt) s cross join (select distinct family from cnt) f left join cnt using (species, family))
 select family, round(stddev_samp(n), 6) as stdev from g group by 1 having stddev_samp(n) >= 0.8""")
def _(t):
    return C.variable_families(cnt(t), 0.8).withColumn("stdev", F.round("stdev", 6))


@query("a13_backbone_counts", """with p as (select n_name as species, (['Nonribosomal Peptide Synthase (NRPS)', 'Polyketide synthase (PKS)', 'Hybrid x', 'other'])[l_partkey % 4 + 1] as product, 'C' || (l_partkey % 50) || l_returnflag as cluster, l_quantity as q
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
 k as (select species, count(*) filter (contains(product, 'NRPS')) as nrps, count(*) filter (contains(product, '(PKS)')) as pks, count(*) filter (contains(product, 'Hybrid')) as hybrid from p group by 1),
 c as (select species, count(distinct cluster) as n_clusters from p group by 1)
 select c.species, coalesce(nrps, 0) as nrps, coalesce(pks, 0) as pks, coalesce(hybrid, 0) as hybrid, n_clusters, n_clusters - coalesce(nrps, 0) - coalesce(pks, 0) - coalesce(hybrid, 0) as other from c left join k on c.species = k.species""")
def _(t):
    kinds = F.array(*[F.lit(x) for x in ("Nonribosomal Peptide Synthase (NRPS)", "Polyketide synthase (PKS)", "Hybrid x", "other")])
    p = (t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
         .select(F.col("n_name").alias("species"), F.get(kinds, (F.col("l_partkey") % 4).cast("int")).alias("product"),
                 F.concat(F.lit("C"), F.col("l_partkey") % 50, "l_returnflag").alias("cluster"), "l_quantity"))
    return C.backbone_counts(p, p)


@query("a14_braycurtis", f"""with {V.FAM}, c as (select species, family, count(*) as n from fam group by 1, 2), s as (select distinct species from c), f as (select distinct family from c),
 g as (select s.species, f.family, coalesce(n, 0) as n from s cross join f left join c using (species, family))
 select a.species as sp_a, b.species as sp_b, round(sum(abs(a.n - b.n)) / sum(a.n + b.n), 6) as distance from g a join g b on a.family = b.family and a.species < b.species group by 1, 2""")
def _(t):
    return C.braycurtis(C.family_counts(V.fam(t))).withColumn("distance", F.round("distance", 6))


@query("j13_factor_counts", f"""with {V.FAM}, {CNT}, tf as (select 'Brand#' || n_nationkey as family, n_name as description from nation where n_nationkey < 12)
 select tf.family, tf.description, s.species, coalesce(n, 0) as n from tf cross join (select distinct species from cnt) s left join cnt on cnt.family = tf.family and cnt.species = s.species""")
def _(t):
    tf = t.nation.where("n_nationkey < 12").select(F.concat(F.lit("Brand#"), "n_nationkey").alias("family"), F.col("n_name").alias("description"))
    return C.factor_counts(cnt(t), tf)


EB = """egg as (select 'g' || p_partkey as gene_id, 'ENOG' || (p_size % 6) as egg from part where p_partkey % 3 > 0), bus as (select 'g' || p_partkey as gene_id, 'B' || (p_size % 4) as busco from part where p_partkey % 2 = 0)"""


def egg_busco(t):
    return (t.part.where("p_partkey % 3 > 0").select(F.concat(F.lit("g"), "p_partkey").alias("gene_id"), F.concat(F.lit("ENOG"), F.col("p_size") % 6).alias("egg")),
            t.part.where("p_partkey % 2 = 0").select(F.concat(F.lit("g"), "p_partkey").alias("gene_id"), F.concat(F.lit("B"), F.col("p_size") % 4).alias("busco")))


@query("a20_ortholog_groups", f"""with {V.ORTH}, {EB}, b as (select group_id from orth group by 1 having count(distinct species) > 1),
 j as (select distinct group_id, gene_id, egg, busco from orth left join egg using (gene_id) left join bus using (gene_id) where group_id in (select group_id from b)),
 m as (select group_id, string_agg(gene_id, ', ' order by gene_id) as members from (select distinct group_id, gene_id from j) group by 1),
 e as (select group_id, string_agg(egg, ', ' order by egg) as eggs from (select distinct group_id, egg from j where egg is not null) group by 1),
 u as (select group_id, string_agg(busco, ', ' order by busco) as buscos from (select distinct group_id, busco from j where busco is not null) group by 1)
 select group_id, coalesce(eggs, 'None') as eggs, coalesce(buscos, 'None') as buscos, members from m left join e using (group_id) left join u using (group_id)""")
def _(t):
    return C.ortholog_groups(V.orth(t), *egg_busco(t))


SC = """sco as (select distinct 'grp' || (l_partkey % 400) as group_id, n_name as species, 'g' || min(l_partkey) as gene_id from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by l_partkey % 400, n_name, case when l_partkey % 5 = 0 then l_partkey else 0 end)"""


def sco(t):
    j = (t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")))
    g = j.groupBy(F.concat(F.lit("grp"), F.col("l_partkey") % 400).alias("group_id"), F.col("n_name").alias("species"),
                  F.when(F.col("l_partkey") % 5 == 0, F.col("l_partkey")).otherwise(0).alias("k")).agg(F.min("l_partkey").alias("m"))
    return g.select("group_id", "species", F.concat(F.lit("g"), "m").alias("gene_id")).distinct()


SCO_OK = """ok as (select group_id from sco group by 1 having count(distinct species) = (select count(distinct species) from sco) and count(*) = (select count(distinct species) from sco))"""


@query("a21_single_copy", f"with {SC}, {SCO_OK} select * from ok")
def _(t):
    return C.single_copy(sco(t))


@query("a22_ortholog_stats", f"""with {V.ORTH}, g as (select group_id, count(distinct species) as k from orth group by 1)
 select species, count(*) as genes, count(*) filter (k = 1) as singletons, count(*) filter (k > 1) as with_orthologs from orth join g using (group_id) group by 1""")
def _(t):
    return C.ortholog_stats(V.orth(t))


@query("j21_busco_consistent_groups", f"""with {V.ORTH}, {EB} select group_id, min(busco) as busco from orth join bus using (gene_id) group by 1 having count(distinct busco) = 1 and min(busco) in ('B1', 'B2')""")
def _(t):
    out = t.nation.where("n_nationkey in (1, 2)").select(F.concat(F.lit("B"), "n_nationkey").alias("busco"))
    return C.busco_consistent_groups(V.orth(t), egg_busco(t)[1], out)


@query("o10_sample_n", f"with {SC}, {SCO_OK} select group_id from ok order by md5(group_id || '|7'), group_id limit 20")
def _(t):
    return C.sample_n(C.single_copy(sco(t)), 20, "group_id", 7)


@query("a33_supermatrix", f"""with {SC}, {SCO_OK} select species, cast(count(*) as int) as n_groups, string_agg(gene_id || p_name, '' order by group_id) as seq from sco join part on gene_id = 'g' || p_partkey where group_id in (select group_id from ok) group by 1""")
def _(t):
    o = sco(t)
    g = o.join(C.single_copy(o), "group_id", "left_semi")
    p = t.part.select(F.concat(F.lit("g"), "p_partkey").alias("gene_id"), F.concat(F.lit("g"), "p_partkey", "p_name").alias("seq"))
    return C.supermatrix(g, g.select("species", "gene_id").join(p, "gene_id"))


@query("a33_supermatrix_pieces", f"""with {SC}, {SCO_OK}, m as (select species, string_agg(gene_id || p_name, '' order by group_id) as seq from sco join part on gene_id = 'g' || p_partkey where group_id in (select group_id from ok) group by 1)
 select species as seq_id, i as piece, i * 500 as "offset", substr(seq, i * 500 + 1, 500) as chunk from (select species, seq, unnest(range(0, (length(seq) + 499) // 500)) as i from m)""")
def _(t):
    o = sco(t)
    g = o.join(C.single_copy(o), "group_id", "left_semi")
    p = t.part.select(F.concat(F.lit("g"), "p_partkey").alias("gene_id"), F.concat(F.lit("g"), "p_partkey", "p_name").alias("seq"))
    return C.supermatrix_pieces(g, g.select("species", "gene_id").join(p, "gene_id"), 500)


@query("a35_duplicate_tags", """select p_brand as tag, count(distinct p_type) as n_genomes from part group by 1 having count(distinct p_type) > 1""")
def _(t):
    return C.duplicate_tags(t.part.select(F.col("p_brand").alias("tag"), F.col("p_type").alias("genome")))


@query("a36_next_locus", """select 'GEN' || (o_orderkey % 3) || '_' as prefix, max(o_orderkey) + 1 as next_number, 7 as width from orders group by 1""")
def _(t):
    g = t.orders.select(F.concat(F.lit("GEN"), F.col("o_orderkey") % 3, F.lit("_"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0")).alias("gene_id"))
    return C.next_locus(g)


@query("s26_poff_to_long", """with w as (select l_orderkey as group_id, string_agg(distinct 'a' || l_partkey, ',' order by 'a' || l_partkey) filter (l_returnflag = 'A') as a, string_agg(distinct 'n' || l_partkey, ',' order by 'n' || l_partkey) filter (l_returnflag = 'N') as n from lineitem group by 1)
 select group_id, 'spA' as species, unnest(string_split(a, ',')) as gene_id from w where a is not null union all select group_id, 'spN', unnest(string_split(n, ',')) from w where n is not null""")
def _(t):
    ids = lambda f, p: F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(F.col("l_returnflag") == f, F.concat(F.lit(p), "l_partkey")))), ","), F.lit("")), F.lit("*"))
    w = t.lineitem.groupBy(F.col("l_orderkey").alias("group_id")).agg(ids("A", "a").alias("spA.faa"), ids("N", "n").alias("spN.faa"))
    return C.poff_to_long(w, ["spA.faa", "spN.faa"])


@query("k11_gene_report", """with g as (select 'g' || p_partkey as gene_id, p_name as product from part), h as (select distinct 'g' || l_partkey as gene_id, case when l_suppkey % 2 = 0 then 'PFAM' else 'CAZy' end as ch, cast(l_suppkey as varchar) as hit from lineitem),
 w as (select gene_id, string_agg(hit, ';' order by hit) filter (ch = 'PFAM') as p, string_agg(hit, ';' order by hit) filter (ch = 'CAZy') as c from h group by 1)
 select g.gene_id, product, coalesce(p, '') as "PFAM", coalesce(c, '') as "CAZy", case when p_size > 25 then 'orth' || p_size else '' end as group_id from g join part on gene_id = 'g' || p_partkey left join w using (gene_id)""")
def _(t):
    genes = t.part.select(F.concat(F.lit("g"), "p_partkey").alias("gene_id"), F.col("p_name").alias("product"))
    ch = t.lineitem.select(F.concat(F.lit("g"), "l_partkey").alias("gene_id"), F.when(F.col("l_suppkey") % 2 == 0, "PFAM").otherwise("CAZy").alias("channel"),
                                                    F.col("l_suppkey").cast("string").alias("hit"))
    orth = t.part.where("p_size > 25").select(F.concat(F.lit("g"), "p_partkey").alias("gene_id"), F.concat(F.lit("orth"), "p_size").alias("group_id"))
    return C.gene_report(genes, ch, orth, ["PFAM", "CAZy"])


@query("j17_go_closure", """with recursive e as (select p_partkey as node, p_partkey // 2 as ancestor from part where p_partkey > 0), c as (select * from e union select c.node, e.ancestor from c join e on c.ancestor = e.node) select distinct * from c""")
def _(t):
    return G.go_closure(t.part.where("p_partkey > 0").select(F.col("p_partkey").alias("node"), F.expr("p_partkey div 2").alias("ancestor")))


@query("a19_components", """with recursive e as (select distinct 'o' || l_orderkey as u, 'p' || (l_orderkey // 60) || '.' || (l_partkey % 7) as v from lineitem), b as (select u, v from e union select v, u from e),
 r as (select u as node, u as seen from b union select r.node, b.v from r join b on r.seen = b.u) select node, min(seen) as component from r group by 1""")
def _(t):
    e = t.lineitem.select(F.concat(F.lit("o"), "l_orderkey").alias("u"), F.concat(F.lit("p"), F.expr("l_orderkey div 60"), F.lit("."), F.col("l_partkey") % 7).alias("v"))
    return G.components(e)


@query("j8_group_loci", """with recursive sp as (select distinct 'c' || l_suppkey as contig, l_partkey * 20 as s, l_partkey * 20 + 10 + cast(l_quantity as bigint) as e from lineitem),
 n as (select *, contig || ':' || printf('%019d', s) || ':' || printf('%019d', e) as id from sp),
 ed as (select a.id as u, b.id as v from n a join n b on a.contig = b.contig and a.s <= b.e and a.e >= b.s and (greatest(least(a.e, b.e) - greatest(a.s, b.s), 0) >= 0.3 * (a.e - a.s) or greatest(least(a.e, b.e) - greatest(a.s, b.s), 0) >= 0.3 * (b.e - b.s))),
 r as (select u as node, v as seen from ed union select r.node, ed.v from r join ed on r.seen = ed.u), c as (select node, min(seen) as locus from r group by 1)
 select n.contig, n.s as "start", n.e as "end", locus from n join c on n.id = c.node""")
def _(t):
    sp = t.lineitem.select(F.concat(F.lit("c"), "l_suppkey").alias("contig"), (F.col("l_partkey") * 20).alias("start"),
                           (F.col("l_partkey") * 20 + 10 + F.col("l_quantity").cast("long")).alias("end")).distinct()
    return G.group_loci(sp)


GOE = """st as (select distinct 'gn' || (l_suppkey % 9) as genome, l_orderkey as gene_id from lineitem), aso as (select distinct l_orderkey as gene_id, 'T' || (l_partkey % 60) as term from lineitem),
 pn as (select count(distinct gene_id) as nn from aso), pc as (select term, count(*) as kk from aso group by 1), s2 as (select * from st where gene_id in (select gene_id from aso)), sn as (select genome, count(*) as n from s2 group by 1),
 h as (select genome, term, count(*) as k from s2 join aso using (gene_id) group by 1, 2), t as (select * from h join sn using (genome) join pc using (term), pn),
 lp as (select *, unnest(range(greatest(0, n + kk - nn), least(n, kk) + 1)) as i from t),
 pr as (select genome, term, k, n, kk, nn, i, lgamma(kk + 1) + lgamma(nn - kk + 1) + lgamma(n + 1) + lgamma(nn - n + 1) - lgamma(nn + 1) - lgamma(i + 1) - lgamma(kk - i + 1) - lgamma(n - i + 1) - lgamma(nn - kk - n + i + 1) as l from lp),
 ob as (select genome, term, l as l0 from pr where i = k), pv as (select genome, term, k, n, kk, nn, least(1.0, sum(exp(l)) filter (l <= l0 + 1e-7)) as p from pr join ob using (genome, term) group by all),
 rk as (select *, count(*) over (partition by genome) as m, row_number() over (partition by genome order by p desc, term) as d from pv),
 f as (select *, min(least(p * m / (m - d + 1), 1.0)) over (partition by genome order by d rows unbounded preceding) as fdr from rk)"""


@query("a18_go_enrichment", f"""with {GOE} select genome, term, k as study_count, n as study_n, kk as pop_count, nn as pop_n, round(p, 6) as p, round(fdr, 6) as fdr, case when k / n > kk / nn then 'over' else 'under' end as direction from f where fdr <= 0.9""")
def _(t):
    st = t.lineitem.select(F.concat(F.lit("gn"), F.col("l_suppkey") % 9).alias("genome"), F.col("l_orderkey").alias("gene_id"))
    aso = t.lineitem.select(F.col("l_orderkey").alias("gene_id"), F.concat(F.lit("T"), F.col("l_partkey") % 60).alias("term"))
    return G.go_enrichment(st, aso, 0.9).withColumn("p", F.round("p", 6)).withColumn("fdr", F.round("fdr", 6))


OLDNEW = f"""{V.IV}, od as (select * from iv where source = 'R'), nw as (select * from iv where source = 'N')"""


def old_new(t):
    f = V.iv(t)
    return f.where("source = 'R'"), f.where("source = 'N'")


@query("j9_diff_by_overlap", f"""with {OLDNEW}, m as (select n.contig, o.name as old_name, o."start" as old_start, o."end" as old_end, n.name as new_name, n."start" as new_start, n."end" as new_end,
  row_number() over (partition by n.contig, n."start", n."end", n.name order by abs(n."start" - o."start") + abs(n."end" - o."end"), o.name, o."start", o."end") as k from nw n join od o on n.contig = o.contig and n."start" <= o."end" and n."end" >= o."start")
 select contig, 'matched' as status, old_name, old_start, old_end, new_name, new_start, new_end from m where k = 1
 union all select contig, 'removed', name, "start", "end", null, null, null from od o where not exists (select 1 from nw n where n.contig = o.contig and n."start" <= o."end" and n."end" >= o."start")
 union all select contig, 'new', null, null, null, name, "start", "end" from nw n where not exists (select 1 from od o where n.contig = o.contig and n."start" <= o."end" and n."end" >= o."start")""")
def _(t):
    return D.diff_models(*old_new(t))


@query("j9_diff_by_id", """with od as (select 'c' || (p_partkey % 40) as contig, p_size * 4 as s, p_size * 4 + 30 as e, p_name || p_partkey as name from part where p_partkey % 3 > 0),
 nw as (select 'c' || (p_partkey % 40) as contig, p_size * 4 + p_partkey % 60 as s, p_size * 4 + p_partkey % 60 + 30 as e, p_name || p_partkey as name from part where p_partkey % 5 > 0),
 j as (select n.*, o.s as os, o.e as oe, o.name as oname from nw n left join od o on n.name = o.name and n.contig = o.contig and o.s <= n.e and o.e >= n.s)
 select contig, case when oname is null then 'new' else 'matched' end as status, oname as old_name, os as old_start, oe as old_end, name as new_name, s as new_start, e as new_end from j
 union all select contig, 'removed', name, s, e, null, null, null from od o where not exists (select 1 from nw n where n.contig = o.contig and n.s <= o.e and n.e >= o.s)""")
def _(t):
    p = t.part
    shift = F.col("p_partkey") % 60
    mk = lambda df, d: df.select(F.concat(F.lit("c"), F.col("p_partkey") % 40).alias("contig"), (F.col("p_size") * 4 + d).cast("long").alias("start"),
                                 (F.col("p_size") * 4 + d + 30).cast("long").alias("end"), F.concat("p_name", "p_partkey").alias("name"))
    return D.diff_models(mk(p.where("p_partkey % 3 > 0"), F.lit(0)), mk(p.where("p_partkey % 5 > 0"), shift), key="id")


EXT = """ex as (select l_orderkey as gene_id, case when l_returnflag = 'R' then 'R' else 'N' end as f, l_suppkey % 3 as tx, l_linenumber * 100 as s, l_linenumber * 100 + cast(max(l_quantity) as bigint) + 1 as e from lineitem group by 1, 2, 3, 4)"""


EXA = """ex as (select l_orderkey as gene_id, l_suppkey % 3 as tx, l_linenumber * 100 as s, l_linenumber * 100 + cast(max(l_quantity) as bigint) + 1 as e from lineitem group by 1, 2, 3)"""


def exon_sets(t, side=None):
    """Exons of the rows flagged R, of all others, or of all rows."""
    rows = t.lineitem if side is None else t.lineitem.where((F.col("l_returnflag") == "R") == F.lit(side == "R"))
    e = rows.groupBy(F.col("l_orderkey").alias("gene_id"), (F.col("l_suppkey") % 3).alias("tx_id"), (F.col("l_linenumber") * 100).cast("long").alias("start")).agg(
        (F.max(F.col("l_quantity").cast("long")) + F.col("start") + 1).alias("end"))
    return e.groupBy("gene_id", "tx_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("exons"))


PAIRED = """n as (select gene_id, tx, sum(e - s) as len, string_agg(s || '-' || e, ',' order by s) as st from ex where f = 'N' group by 1, 2), r as (select gene_id, tx, sum(e - s) as len, string_agg(s || '-' || e, ',' order by s) as st from ex where f = 'R' group by 1, 2),
 ov as (select a.gene_id, a.tx as qtx, b.tx as rtx, sum(greatest(0, least(a.e, b.e) - greatest(a.s, b.s))) as o from ex a join ex b on a.gene_id = b.gene_id and a.f = 'N' and b.f = 'R' group by 1, 2, 3),
 d as (select n.gene_id, n.tx as qtx, r.tx as rtx, case when n.st = r.st then 0.0 else 1 - (o / n.len + o / r.len) / 2 end as aed from ov join n on n.gene_id = ov.gene_id and n.tx = qtx join r on r.gene_id = ov.gene_id and r.tx = rtx)"""


@query("a27_aed", f"with {EXT}, {PAIRED} select gene_id, qtx, rtx, round(aed, 6) as aed from d")
def _(t):
    q, r = exon_sets(t, "N"), exon_sets(t, "R")
    j = q.withColumnsRenamed({"tx_id": "qtx", "exons": "q"}).join(r.withColumnsRenamed({"tx_id": "rtx", "exons": "r"}), "gene_id")
    return j.select("gene_id", "qtx", "rtx", F.round(S.aed(F.col("q"), F.col("r")), 6).alias("aed"))


@query("a28_gene_aed", f"with {EXT}, {PAIRED}, m as (select gene_id, qtx, min(aed) as a from d group by 1, 2) select gene_id as new_gene, gene_id as old_gene, round(avg(a), 3) as aed from m group by 1")
def _(t):
    q, r = exon_sets(t, "N"), exon_sets(t, "R")
    pairs = q.select(F.col("gene_id").alias("new_gene"), F.col("gene_id").alias("old_gene")).distinct().join(r.select(F.col("gene_id").alias("old_gene")).distinct(), "old_gene", "left_semi")
    return D.gene_aed(pairs, q, r)


@query("w9_classify_change", """with d as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey % 2 = 1 as moved, l_suppkey % 4 = 1 as f, l_suppkey % 5 = 1 as th, l_discount as m, case when l_tax > 0.04 then l_tax else 0 end as c, cast(l_quantity as bigint) as p from lineitem),
 x as (select *, concat_ws(';', case when moved then 'gene coordinates updated' end, case when moved and f then '5prime UTR added' end, case when moved and th then '3prime UTR added' end, case when m > 0 then 'mRNA updated' end,
  case when c > 0 then 'CDS update [translation pident: ' || p || '%, 100%]' end) as msg from d)
 select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when msg = '' then 'no change' else msg end as message, case when msg = '' then 'no_change' when moved and (f or th) then 'utr_added' when m > 0 then 'exon_changed' else 'other' end as class from x""")
def _(t):
    c = D.classify_change(F.col("l_partkey") % 2 == 1, F.col("l_suppkey") % 4 == 1, F.col("l_suppkey") % 5 == 1, F.col("l_discount"),
                          F.when(F.col("l_tax") > 0.04, F.col("l_tax")).otherwise(0.0), F.array(F.col("l_quantity"), F.lit(100.0)))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c.alias("c")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c.message", "c.class")


DIFFT = """df as (select case l_returnflag when 'A' then 'removed' when 'N' then 'new' else 'matched' end as status, case when l_returnflag = 'A' then 1.0 else l_discount end as ma, case when l_returnflag = 'A' then 1.0 when l_tax > 0.04 then l_tax else 0.0 end as ca,
 case when l_returnflag <> 'R' then null when l_suppkey % 4 = 0 then 'no_change' when l_suppkey % 4 = 1 then 'utr_added' when l_suppkey % 4 = 2 then 'exon_changed' else 'other' end as cl from lineitem)"""


def diff_rows(t):
    rem = F.col("l_returnflag") == "A"
    s4 = F.col("l_suppkey") % 4
    return t.lineitem.select(
        F.when(rem, "removed").when(F.col("l_returnflag") == "N", "new").otherwise("matched").alias("status"), F.when(rem, 1.0).otherwise(F.col("l_discount")).alias("mrna_aed"),
        F.when(rem, 1.0).when(F.col("l_tax") > 0.04, F.col("l_tax")).otherwise(0.0).alias("cds_aed"),
        F.when(F.col("l_returnflag") == "R", F.when(s4 == 0, "no_change").when(s4 == 1, "utr_added").when(s4 == 2, "exon_changed").otherwise("other")).alias("class"))


@query("a29_compare_summary", f"""with {DIFFT}, d as (select count(*) filter (status = 'removed') as ru, count(*) filter (status = 'new') as qu, count(*) filter (status = 'matched' and ma = 0 and ca = 0) as un, count(*) filter (status = 'matched' and ma > 0 and ca = 0) as sc, round(avg(ma), 3) as am, round(avg(ca), 3) as ac from df),
 o as (select case when p_size % 9 = 0 then 'tRNA' else 'mRNA' end as b, p_size as n from part where p_partkey % 2 = 0), n as (select case when p_size % 9 = 0 then 'tRNA' else 'mRNA' end as b, p_size as n from part where p_partkey % 2 = 1)
 select 'reference' as side, count(*) as loci, count(*) filter (b = 'mRNA') as mrna_loci, cast(sum(n) filter (b = 'mRNA') as bigint) as mrna_tx, count(*) filter (b = 'tRNA') as trna_loci, cast(sum(n) filter (b = 'tRNA') as bigint) as trna_tx, max(ru) as unique, max(un) as unchanged, max(sc) as same_cds, 0.0::double as avg_mrna_aed, 0.0::double as avg_cds_aed from o, d
 union all select 'query', count(*), count(*) filter (b = 'mRNA'), cast(sum(n) filter (b = 'mRNA') as bigint), count(*) filter (b = 'tRNA'), cast(sum(n) filter (b = 'tRNA') as bigint), max(qu), max(un), max(sc), max(am), max(ac) from n, d""")
def _(t):
    side = lambda r: t.part.where(f"p_partkey % 2 = {r}").select(F.when(F.col("p_size") % 9 == 0, "tRNA").otherwise("mRNA").alias("biotype"), F.col("p_size").alias("n_tx"))
    return D.compare_summary(diff_rows(t), side(0), side(1))


@query("a30_update_summary", f"""with {DIFFT} select count(*) filter (status <> 'removed') as total_genes, count(*) filter (status = 'new') as new_genes, count(*) filter (cl = 'no_change') as no_change, count(*) filter (cl = 'utr_added') as utr_added,
 count(*) filter (cl = 'exon_changed') as exon_changed, count(*) filter (cl = 'other') as other_changes, count(*) filter (status = 'removed') as dropped, round(avg(ma), 3) as mean_mrna_aed, round(avg(ca), 3) as mean_cds_aed from df""")
def _(t):
    return D.update_summary(diff_rows(t))


@query("f23_lcs_identity")
def _(t):
    d = t.documents.select("doc_id", "text", "source", "lang")
    low = d.groupBy("source", "lang").agg(F.min_by("text", "doc_id").alias("first_text"))
    return D.add_identity(d.join(low, ["source", "lang"]), "text", "first_text").select("doc_id", F.round("pident", 4).alias("pident"))


@query("f23_short_identity", """with recursive p as (select p_partkey as id, string_split(p_name, '') as a, string_split(p_type, '') as b from part),
 r as (select id, a, b, 0 as i, list_transform(a, lambda x: 0) as row from p
  union all select id, a, b, i + 1, list_transform(range(1, len(a) + 1), lambda k: list_max(list_transform(range(1, k + 1), lambda j: greatest(row[j], case when a[j] = b[i + 1] then coalesce(row[j - 1], 0) + 1 else 0 end)))) from r where i < len(b))
 select id as p_partkey, round(100.0 * row[len(a)] / greatest(len(a), len(b)), 4) as pident from r where i = len(b)""")
def _(t):
    return D.add_identity(t.part.select("p_partkey", "p_name", "p_type"), "p_name", "p_type").select("p_partkey", F.round("pident", 4).alias("pident"))


@query("f16_utr_flags", f"""with {EXA}, x as (select gene_id, tx, min(s) as a, max(e) as b from ex group by 1, 2)
 select gene_id, tx as tx_id, case when gene_id % 2 = 0 then true else tx > 0 end as five, case when gene_id % 2 = 0 then tx > 0 else true end as three from x""")
def _(t):
    n = exon_sets(t)
    span = F.array(F.struct((F.col("exons")[0]["start"] + 5).alias("start"),
                            (F.element_at("exons", -1)["end"] - F.when(F.col("tx_id") > 0, 1).otherwise(0)).alias("end")))
    strand = F.when(F.col("gene_id") % 2 == 0, "+").otherwise("-")
    f = n.select("gene_id", "tx_id", D.utr_flags(F.col("exons"), span, strand).alias("u"))
    return f.select("gene_id", "tx_id", "u.five", "u.three")


@query("f16_utr_parts", f"""with {EXA}, x as (select * from ex), c as (select gene_id, tx, min(s) + 130 as lo, max(e) - 10 as hi from x group by 1, 2),
 l as (select x.gene_id, x.tx, x.s, least(x.e, lo - 1) as e, case when x.gene_id % 2 = 0 then 'five' else 'three' end as part from x join c using (gene_id, tx) where x.s < lo),
 r as (select x.gene_id, x.tx, greatest(x.s, hi + 1) as s, x.e, case when x.gene_id % 2 = 0 then 'three' else 'five' end as part from x join c using (gene_id, tx) where x.e > hi)
 select gene_id, tx as tx_id, part, s as "start", e as "end" from (select * from l union all select gene_id, tx, s, e, part from r)""")
def _(t):
    n = exon_sets(t)
    cds = F.array(F.struct((F.col("exons")[0]["start"] + 130).alias("start"), (F.element_at("exons", -1)["end"] - 10).alias("end")))
    strand = F.when(F.col("gene_id") % 2 == 0, "+").otherwise("-")
    u = n.select("gene_id", "tx_id", S.utr_parts(F.col("exons"), cds, strand).alias("u"))
    five = u.select("gene_id", "tx_id", F.lit("five").alias("part"), F.explode_outer("u.five").alias("e"))
    three = u.select("gene_id", "tx_id", F.lit("three").alias("part"), F.explode_outer("u.three").alias("e"))
    return five.unionByName(three).where("e is not null").select("gene_id", "tx_id", "part", "e.start", "e.end")


@query("k11_full_gene_report", """with h as (select 'g' || l_partkey as gene_id, (['InterPro', 'PFAM', 'MEROPS', 'CAZy', 'GO', 'BUSCO', 'Secreted'])[l_linenumber] as ch, l_orderkey as ord, (['InterPro', 'PFAM', 'MEROPS', 'CAZy', 'GO', 'BUSCO', 'Secreted'])[l_linenumber] || l_suppkey || ': d' as hit, l_suppkey as k from lineitem),
 w as (select gene_id, string_agg(hit, '; ' order by ord, hit) filter (ch = 'InterPro') as ip, string_agg(hit, '; ' order by ord, hit) filter (ch = 'PFAM') as pf, string_agg(hit, '; ' order by ord, hit) filter (ch = 'MEROPS') as me, string_agg(hit, '; ' order by ord, hit) filter (ch = 'CAZy') as ca,
  string_agg(hit, '; ' order by ord, hit) filter (ch = 'GO') as go, substr(min(printf('%012d', ord) || hit) filter (ch = 'BUSCO'), 13) as bu, substr(min(printf('%012d', ord) || hit) filter (ch = 'Secreted'), 13) as se, substr(max(printf('%012d', ord) || n_name) filter (ch = 'InterPro' and n_name is not null), 13) as tf from h left join nation on n_nationkey = k group by 1)
 select 'g' || p_partkey as "GeneID", p_brand || ':' || (p_size - 1) || '-' || (p_size + 90) as "scaffold:start-end", '+' as strand, cast(p_size as varchar) as length, p_name as description, case when p_size > 25 then 'orth' || p_size else '' end as "Ortho Group",
  'E' || p_size as "EggNog", coalesce(bu, '') as "BUSCO", coalesce(se, '') as "Secreted", '' as "TransMembrane", coalesce(me, '') as "Protease family", coalesce(ca, '') as "CAZyme family", coalesce(tf, '') as "Transcription factor",
  coalesce(ip, '') as "InterPro Domains", coalesce(pf, '') as "PFAM Domains", coalesce(go, '') as "GO terms", case when p_size % 2 = 0 then 'C' || p_size else '' end as "SecMet Cluster", 'SMCOG:x' as "SMCOG" from part left join w on gene_id = 'g' || p_partkey""")
def _(t):
    n = F.col("p_size")
    genes = t.part.select(F.concat(F.lit("g"), "p_partkey").alias("gene_id"), F.col("p_brand").alias("contig"), n.alias("start"), (n + 90).alias("end"), F.lit("+").alias("strand"), n.alias("protein_length"),
                          F.col("p_name").alias("product"), F.array_compact(F.array(F.lit("EggNog:old"), F.concat(F.lit("EggNog:E"), n), F.when(n % 2 == 0, F.concat(F.lit("antiSMASH:C"), n)), F.lit("SMCOG:x"))).alias("notes"))
    kind = F.element_at(F.array(*[F.lit(k) for k in ("InterPro", "PFAM", "MEROPS", "CAZy", "GO", "BUSCO", "Secreted")]), F.col("l_linenumber").cast("int"))
    hits = t.lineitem.select(F.concat(F.lit("g"), "l_partkey").alias("gene_id"), kind.alias("channel"), F.col("l_orderkey").alias("ord"), F.concat(kind, "l_suppkey", F.lit(": d")).alias("hit"))
    orth = t.part.where("p_size > 25").select(F.concat(F.lit("g"), "p_partkey").alias("gene_id"), F.concat(F.lit("orth"), "p_size").alias("group_id"))
    factors = t.nation.select(F.concat(F.lit("InterPro"), "n_nationkey").alias("term"), F.col("n_name").alias("description"))
    return C.full_gene_report(genes, hits, orth, factors)
