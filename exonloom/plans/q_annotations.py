"""Registered annotation and naming queries."""

from pyspark.sql import functions as F

from ..functions import naming as N
from ..operators import annotations as A
from ..scale import spread
from . import views as V
from .registry import query


def sql_str(s):
    return "'" + s.replace("'", "''") + "'"


def rules_sql(col: str) -> str:
    """The ordered rules as nested SQL calls; look-ahead is spelled with a marker."""
    out = col
    for pat, rep in N.PRODUCT_RULES:
        if "(?!" in pat:
            out = f"regexp_replace({out}, '(?i)\\b(conserv)(ed\\s+domain)', '\\1~\\2', 'g')"
            out = f"replace(regexp_replace({out}, '(?i)\\bconserved\\b', '', 'g'), '~', '')"
            continue
        out = f"regexp_replace({out}, {sql_str(pat)}, {sql_str(rep.replace('$1', chr(92) + '1'))}, 'g')"
    return out


PHRASES = ["", "probable ", "Homolog to Saccharomyces cerevisiae gpr1 ", "conserved domain ", "conserved ", "kinase protein ", "binds ", "type II (",
           "novel human gene", "similar to ", "EC 1.1.1.1 ", "Alpha subunit (", "protein protein ", "to Required for ", "uncharacterised ORF "]
ARR = "[" + ", ".join(sql_str(p) for p in PHRASES) + "]"
PRODUCTS = f"""lines as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as no from documents),
 prod as (select doc_id || '.' || no as id, 'Abc' || (doc_id % 50) as name, ({ARR})[(doc_id + no) % {len(PHRASES)} + 1] || regexp_replace(line, '[^A-Za-z0-9 .,()-]', '', 'g') as product from lines)"""


def products(t):
    arr = F.array(*[F.lit(p) for p in PHRASES])
    lines = spread(t.documents.select("doc_id", "text")).select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("no", "line"))
    no = F.col("no") + 1
    return lines.select(F.concat_ws(".", "doc_id", no).alias("id"), F.concat(F.lit("Abc"), F.col("doc_id") % 50).alias("name"),
                        F.concat(F.get(arr, ((F.col("doc_id") + no) % len(PHRASES)).cast("int")), F.regexp_replace("line", "[^A-Za-z0-9 .,()-]", "")).alias("product"))


SENT = ("(" + " or ".join(f"contains(r, {sql_str(p)})" for p in N.SENTENCE_PHRASES) + " or r = 'protein ' || name or length(r) > 100 or "
        f"regexp_matches(r, {sql_str(N.SENTENCE_VERBS)}))")
TIDY = """t1 as (select *, replace(trim(regexp_replace(b, '\\s+', ' ', 'g')), '()', '') as c from st),
 t2 as (select *, replace(case when contains(c, '(') and not contains(c, ')') then rtrim(split_part(c, '(', 1)) else c end, ' ,', ',') as clean from t1)"""


def clean_sql(src):
    return f"""ru as (select *, replace({rules_sql('product')}, name, lower(name)) as r from {src}),
 st as (select *, case when {SENT} then upper(substr(name, 1, 1)) || lower(substr(name, 2)) || 'p' else r end as b, {SENT} as sentence from ru), {TIDY}"""


@query("f18_clean_product", f"""with {PRODUCTS}, {clean_sql('prod')} select id, name, clean from t2""")
def _(t):
    return N.add_clean_product(products(t)).select("id", "name", "clean")


CAND = """cand as (select 'G' || l_orderkey as id, l_linenumber * 100000 + l_partkey as ord, case when l_suppkey % 3 = 0 then 'Nm' else 'nM' end || (l_partkey % 60) as name,
  'prod ' || l_suppkey as product, count(*) as n from lineitem group by 1, 2, 3, 4),
 one as (select id, ord, min(name) as name, min(product) as product from cand group by 1, 2),
 cur as (select 'nm' || p_partkey as name, 'Curated ' || p_name as product from part where p_partkey < 20)"""


def candidates(t):
    c = t.lineitem.select(F.concat(F.lit("G"), "l_orderkey").alias("id"), (F.col("l_linenumber") * 100000 + F.col("l_partkey")).alias("ord"),
                          F.concat(F.when(F.col("l_suppkey") % 3 == 0, "Nm").otherwise("nM"), F.col("l_partkey") % 60).alias("name"), F.concat(F.lit("prod "), "l_suppkey").alias("product"))
    c = c.groupBy("id", "ord").agg(F.min("name").alias("name"), F.min("product").alias("product"))
    cur = t.part.where("p_partkey < 20").select(F.concat(F.lit("nm"), "p_partkey").alias("name"), F.concat(F.lit("Curated "), "p_name").alias("product"))
    return c, cur


@query("j10_lookup_curated", f"""with {CAND} select o.id, o.ord, o.name, coalesce(a.product, b.product) as curated_product from one o left join cur a on o.name = a.name left join cur b on lower(o.name) = b.name""")
def _(t):
    c, cur = candidates(t)
    return A.lookup_curated(c, cur).select("id", "ord", "name", "curated_product")


@query("o15_choose_product", f"""with {CAND}, j as (select o.*, coalesce(a.product, b.product) as cp, a.product is not null as ex from one o left join cur a on o.name = a.name left join cur b on lower(o.name) = b.name),
 k as (select *, row_number() over (partition by id order by case when cp is null then 1 else 0 end, case when cp is null then ord else -ord end) as r from j)
 select id, name, coalesce(cp, product) as product, ex as curated from k where r = 1""")
def _(t):
    return A.choose_product(*candidates(t))


@query("k17_curation_reports", f"""with {PRODUCTS}, {clean_sql('prod')}, f as (select 'Abc' || n_nationkey as name from nation where n_nationkey % 4 = 0), c as (select 'Abc' || n_nationkey as name from nation where n_nationkey % 6 = 1)
 select id, name, clean as product, case when name in (select name from f) then 'must_fix' when sentence then 'need_curating' else 'passed' end as report from t2 where name not in (select name from c)""")
def _(t):
    p = products(t)
    nat = t.nation.select(F.concat(F.lit("Abc"), "n_nationkey").alias("name"), "n_nationkey")
    none = nat.where("n_nationkey < 0").select("name", F.lit("x").alias("product"))
    named = A.name_products(p.withColumn("ord", F.lit(1)), none)
    rep = A.curation_reports(named, nat.where("n_nationkey % 4 = 0"), nat.where("n_nationkey % 6 = 1"))
    return rep.select("id", "name", "product", "report")


@query("w7_suffix_duplicates", f"""with {V.ANNOTS}, n as (select 'G' || cast(split_part(substr(id, 6), '-T', 1) as bigint) || '-T' || split_part(id, '-T', 2) as id, cast(split_part(substr(id, 6), '-T', 1) as bigint) as k, min(value) as name from annots where ref_db = 'name' group by all),
 g as (select name, count(distinct split_part(id, '-T', 1)) as g from n group by 1)
 select id, n.name, case when g > 1 then n.name || '_' || row_number() over (partition by n.name order by k, id) else n.name end as final_name from n join g on n.name = g.name""")
def _(t):
    unpadded = F.expr("concat('G', cast(substring_index(substr(id, 6), '-T', 1) as bigint), '-T', substring_index(id, '-T', -1))")
    n = V.annots(t).where("ref_db = 'name'").groupBy(unpadded.alias("id")).agg(F.min("value").alias("name"))
    return A.suffix_duplicates(n)


KEYED = """keyed as (select case when ref_db in ('name', 'product') then split_part(id, '-T', 1) else id end as id, ref_db, value from annots where value <> '')"""


@query("u3_union_annotations", f"""with {V.ANNOTS} select id, ref_db, value, count(*) as copies from (select * from annots union all select * from annots where event_id % 7 = 0) group by 1, 2, 3""")
def _(t):
    a = V.annots(t)
    return A.union_annotations(a, a.where("event_id % 7 = 0"))


@query("p18_valid_annotations", f"""with {V.ANNOTS} select * from annots where (id like 'GENE_000%' or id like 'GENE_0010%') and value is not null""")
def _(t):
    return A.valid_annotations(V.annots(t), ["GENE_000", "GENE_0010"])


@query("a16_collect_annotations", f"""with {V.ANNOTS}, {KEYED} select id, ref_db, value, row_number() over (partition by id, ref_db order by value) as pos from (select distinct * from keyed)""")
def _(t):
    return A.collect_annotations(V.annots(t))


@query("a16_annotation_dictionary", f"""with {V.ANNOTS}, {KEYED} select id, ref_db, string_agg(value, ';' order by value) as values from (select distinct * from keyed) group by 1, 2""")
def _(t):
    return A.annotation_dictionary(V.annots(t))


@query("u5_merge_override", f"""with {V.ANNOTS}, b as (select id, ref_db, 'new' as value from annots where event_id % 11 = 0) select id, ref_db, value from annots a where not exists (select 1 from b where b.id = a.id and b.ref_db = a.ref_db)
 union all select * from b""")
def _(t):
    a = V.annots(t)
    return A.merge_override(a.select("id", "ref_db", "value"), a.where("event_id % 11 = 0").withColumn("value", F.lit("new")), ["id", "ref_db"])


@query("u6_apply_custom", f"""with {V.ANNOTS}, {KEYED}, b as (select distinct * from keyed),
 m as (select split_part(id, '-T', 1) as id, case when event_id % 2 = 0 then ref_db else case when ref_db = 'name' then 'gene_synonym' else ref_db end end as ref_db, case when event_id % 3 = 0 then value else 'c' || value end as value, event_id as ord
   from annots where event_id % 5 = 0 and ref_db in ('name', 'product') union all
   select id, ref_db, value || 'x', event_id from annots where event_id % 5 = 0 and ref_db not in ('name', 'product')),
 l as (select id, ref_db, max_by(value, (ord, value)) as value from m where ref_db in ('name', 'product') group by 1, 2),
 r as (select * from b where (id, ref_db) not in (select id, ref_db from l) union all select * from l union all select id, ref_db, value from m where ref_db not in ('name', 'product')
   union all select id, 'gene_synonym', value from (select * from b where ref_db = 'name' union all select id, ref_db, value from m where ref_db = 'name') where id in (select id from l where ref_db = 'name')),
 s as (select distinct * from r where ref_db = 'gene_synonym')
 select * from r where ref_db <> 'gene_synonym' union all select * from s where (id, value) not in (select id, value from r where ref_db = 'name')""")
def _(t):
    a = V.annots(t)
    base = A.key_annotations(a).select("id", "ref_db", "value").distinct()
    c = a.where("event_id % 5 = 0")
    gene = c.where("ref_db in ('name', 'product')").select(
        "id", F.when((F.col("event_id") % 2 != 0) & (F.col("ref_db") == "name"), "gene_synonym").otherwise(F.col("ref_db")).alias("ref_db"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).otherwise(F.concat(F.lit("c"), "value")).alias("value"), F.col("event_id").alias("ord"))
    rest = c.where("ref_db not in ('name', 'product')").select("id", "ref_db", F.concat("value", F.lit("x")).alias("value"), F.col("event_id").alias("ord"))
    return A.apply_custom(base, gene.unionByName(rest))


@query("u7_apply_fixes", f"""with {V.ANNOTS}, b as (select distinct id, ref_db, value from annots), fx as (select 'GENE_' || printf('%05d', n_nationkey * 3) || '-T1' as id, n_name as name, 'P' || n_nationkey as product from nation),
 kf as (select * from fx where id in (select id from b)), f as (select id, 'name' as ref_db, name as value from kf union all select id, 'product', product from kf),
 rm as (select 'GENE_' || printf('%05d', n_nationkey * 5) || '-T1' as id from nation),
 m as (select * from b where (id, ref_db) not in (select id, ref_db from f) union all select * from f)
 select * from m where id not in (select id from rm) or ref_db not in ('name', 'product')""")
def _(t):
    b = V.annots(t).select("id", "ref_db", "value").distinct()
    gid = lambda k: F.concat(F.lit("GENE_"), F.format_string("%05d", F.col("n_nationkey") * k), F.lit("-T1")).alias("id")
    fx = t.nation.select(gid(3), F.col("n_name").alias("name"), F.concat(F.lit("P"), "n_nationkey").alias("product"))
    return A.apply_fixes(b, fx, t.nation.select(gid(5)))


NOTES = """nt as (select 'g' || l_orderkey as id, case when l_suppkey % 10 < 8 then 'note' else 'db_xref' end as ref_db,
  (['EggNog:E', 'BUSCO:B', 'MEROPS:M', 'CAZy:GH', 'COG:K,L', 'SECRETED:S', 'SMCOG1001:x', 'free text ', 'PFAM:PF', 'InterPro:IPR'])[l_suppkey % 10 + 1] || l_partkey as value from lineitem)"""
NOTE_KINDS = ["EggNog:E", "BUSCO:B", "MEROPS:M", "CAZy:GH", "COG:K,L", "SECRETED:S", "SMCOG1001:x", "free text ", "PFAM:PF", "InterPro:IPR"]


def notes(t):
    arr = F.array(*[F.lit(x) for x in NOTE_KINDS])
    s = (F.col("l_suppkey") % 10).cast("int")
    return t.lineitem.select(F.concat(F.lit("g"), "l_orderkey").alias("id"), F.when(s < 8, "note").otherwise("db_xref").alias("ref_db"), F.concat(F.get(arr, s), "l_partkey").alias("value"))


ROUTED = """pf as (select *, case when contains(value, ':') then split_part(value, ':', 1) end as prefix from nt),
 kn as (select *, coalesce(case when ref_db = 'db_xref' then prefix in ('PFAM', 'InterPro') else prefix in ('EggNog', 'BUSCO', 'MEROPS', 'CAZy', 'COG', 'SECRETED', 'TransMembrane', 'antiSMASH') end, false) as k from pf),
 ro as (select id, ref_db, value, case when k then prefix else 'other' end as channel, case when k then substr(value, length(prefix) + 2) else value end as h from kn),
 routed as (select id, ref_db, value, channel, unnest(case when channel = 'COG' then string_split(h, ',') else [h] end) as hit from ro)"""


@query("p19_route_notes", f"with {NOTES}, {ROUTED} select * from routed")
def _(t):
    return A.route_notes(notes(t))


@query("a34_note_headers", f"with {NOTES} select distinct split_part(value, ':', 1) as header from nt where ref_db = 'note' and contains(value, ':') and value not like 'SMCOG%'")
def _(t):
    return A.note_headers(notes(t))


@query("a34_distinct_terms", f"with {NOTES} select distinct split_part(value, ':', 2) as term from nt where value like 'InterPro:%'")
def _(t):
    return A.distinct_terms(notes(t))


@query("a15_invert", """select l_suppkey, string_agg(k, ';' order by k) as l_partkeys from (select distinct l_suppkey, cast(l_partkey as varchar) as k from lineitem) group by 1""")
def _(t):
    return A.invert(t.lineitem, "l_partkey", "l_suppkey")


@query("a15_flip_first", """select l_suppkey, min(l_partkey) as l_partkey from lineitem group by 1""")
def _(t):
    return A.flip_first(t.lineitem, "l_partkey", "l_suppkey")


@query("j11_with_descriptions", """select l_orderkey, l_linenumber, l_partkey as term, coalesce(p_name, 'No description') as description from lineitem left join (select * from part where p_size % 3 > 0) on p_partkey = l_partkey""")
def _(t):
    return A.with_descriptions(t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("term")),
                               t.part.where("p_size % 3 > 0").select(F.col("p_partkey").alias("term"), F.col("p_name").alias("description")))


@query("j12_go_category", """with tm as (select p_partkey, p_name, p_size, case p_size % 3 when 0 then 'go_process' when 1 then 'go_function' else 'go_component' end as q from part where p_partkey % 2 = 0),
 ids as (select 'GO:' || lpad(cast(p_partkey as varchar), 7, '0') as id, * from tm union all select 'GO:' || lpad(cast(p_partkey + 1 as varchar), 7, '0'), * from tm where p_size > 25),
 h as (select distinct 'GO:' || lpad(cast(l_partkey as varchar), 7, '0') as go_id from lineitem)
 select go_id, q as qualifier, q || chr(9) || p_name || '|' || replace(go_id, 'GO:', '') || '||IEA' as line from h join ids on id = go_id""")
def _(t):
    gid = lambda c: F.concat(F.lit("GO:"), F.lpad(c.cast("string"), 7, "0"))
    ns = F.when(F.col("p_size") % 3 == 0, "biological_process").when(F.col("p_size") % 3 == 1, "molecular_function").otherwise("cellular_component")
    terms = t.part.where("p_partkey % 2 = 0").select(gid(F.col("p_partkey")).alias("go_id"), F.col("p_name").alias("name"), ns.alias("namespace"),
                                                     F.when(F.col("p_size") > 25, F.array(gid(F.col("p_partkey") + 1))).alias("alt_ids"))
    h = t.lineitem.select(gid(F.col("l_partkey")).alias("go_id")).distinct()
    return A.go_category(h, terms).select("go_id", "qualifier", "line")


@query("a17_go_associations", """with g as (select distinct 'g' || l_suppkey as id, 'GO:' || lpad(cast(l_partkey % 40 as varchar), 7, '0') as v from lineitem)
 select id, string_agg(v, ';' order by v) as terms, count(*) as n_terms from g group by 1""")
def _(t):
    a = t.lineitem.select(F.concat(F.lit("g"), "l_suppkey").alias("id"),
                                                   F.concat(F.lit("GO:"), F.lpad((F.col("l_partkey") % 40).cast("string"), 7, "0")).alias("value"))
    return A.go_associations(a)


@query("u10_merge_secretome", """with p as (select 'g' || p_partkey as id, p_size % 4 as tm, case when p_size % 5 = 0 then 'Y' else '0' end as sp, 'n8-18c' || p_size || '/24o' as pr from part)
 select id, 'note' as ref_db, 'TransMembrane:' || tm || ' (' || pr || ')' as value from p where tm > 0
 union all select id, 'note', 'SECRETED:SignalP(1-' || split_part(split_part(pr, '/', 1), 'c', 2) || ')' from p where sp = 'Y'""")
def _(t):
    p = t.part.select(F.concat(F.lit("g"), "p_partkey").alias("id"), (F.col("p_size") % 4).alias("tm"), F.when(F.col("p_size") % 5 == 0, "Y").otherwise("0").alias("sp"),
                      F.concat(F.lit("n8-18c"), "p_size", F.lit("/24o")).alias("prediction"))
    return A.merge_secretome(p, None)


@query("f22_secretion_notes", """select 'g' || p_partkey as id, 'note' as ref_db, case when p_size % 2 = 0 then 'SECRETED:SignalP(1-' || p_size || ',cutsite=AAS,prob=0.9' || (p_size % 10) || ')' else 'SECRETED:SignalP(1-' || p_size || ')' end as value from part
 union all select 'g' || p_partkey, 'note', 'TransMembrane:' || (p_size % 4) || ' (i1o)' from part where p_size % 4 > 0""")
def _(t):
    p = t.part.select(F.concat(F.lit("g"), "p_partkey").alias("id"), (F.col("p_size") % 4).alias("tm"), F.lit("0").alias("sp"), F.lit("i1o").alias("prediction"))
    s = t.part.select(F.concat(F.lit("g"), "p_partkey").alias("id"), F.col("p_size").alias("end"), F.when(F.col("p_size") % 2 == 0, "AAS").otherwise("").alias("cut"),
                      F.concat(F.lit("0.9"), F.col("p_size") % 10).alias("prob"))
    return A.merge_secretome(p, s)


EGG = """eg as (select 'p' || l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey as query, case when l_suppkey % 9 = 0 then '' else 'A' || l_partkey || '@1|root,' end || 'B' || l_suppkey || '@2|Fungi' as ogs,
  case when l_suppkey % 4 = 0 then '1|root' else '2|Fungi' end as tax, case when l_linenumber = 1 then '-' else 'ABC' || (l_partkey % 150) end as symbol, case when l_tax > 0.05 then 'KL T' when l_tax > 0.02 then 'S' else '-' end as cogs,
  case when l_discount > 0.07 then '1.2.3.4,1.2.3.5' when l_discount > 0.03 then '1.' || l_linenumber || '.1.1' else '-' end as ec, 'Does it. And more' as description from lineitem)"""


def egg(t):
    return t.lineitem.select(
        F.concat_ws(".", F.concat(F.lit("p"), "l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey").alias("query"),
        F.concat(F.when(F.col("l_suppkey") % 9 == 0, "").otherwise(F.concat(F.lit("A"), "l_partkey", F.lit("@1|root,"))), F.lit("B"), "l_suppkey", F.lit("@2|Fungi")).alias("ogs"),
        F.when(F.col("l_suppkey") % 4 == 0, "1|root").otherwise("2|Fungi").alias("tax"),
        F.when(F.col("l_linenumber") == 1, "-").otherwise(F.concat(F.lit("ABC"), F.col("l_partkey") % 150)).alias("symbol"),
        F.when(F.col("l_tax") > 0.05, "KL T").when(F.col("l_tax") > 0.02, "S").otherwise("-").alias("cogs"),
        F.when(F.col("l_discount") > 0.07, "1.2.3.4,1.2.3.5").when(F.col("l_discount") > 0.03, F.concat(F.lit("1."), "l_linenumber", F.lit(".1.1"))).otherwise("-").alias("ec"),
        F.lit("Does it. And more").alias("description"))


@query("f20_eggnog_annotations", f"""with {EGG}, d as (select query, 'ENOG50' || case when tax = '1|root' then case when l9 then '' else split_part(ogs, '@', 1) end else regexp_extract(ogs, '(B[0-9]+)@', 1) end as nog,
   case when ec = '1.2.3.4,1.2.3.5' then '1.2.3' when ec = '-' then '' else ec end as ec, case cogs when 'KL T' then 'K,L,T' when 'S' then 'S' else '' end as cogs,
   case when symbol <> '-' and length(regexp_replace(symbol, '[^0-9]', '', 'g')) between 1 and 2 then symbol end as symbol from (select *, ogs not like 'A%' as l9 from eg))
 select query as id, 'EC_number' as ref_db, ec as value from d where ec <> '' union all select query, 'note', 'EggNog:' || nog from d union all select query, 'note', 'COG:' || cogs from d where cogs <> ''
 union all select query, 'name', symbol from d where symbol is not null union all select query, 'product', 'Does it' from d where symbol is not null""")
def _(t):
    return A.eggnog_annotations(egg(t))


@query("f21_backbone_product", """with b as (select p_partkey, (['terpene', 'other', 'indole', 'alkaloid', 'putative', 't1pks-nrps', 'none', 'siderophore'])[p_size % 8 + 1] as bb, case when p_size % 5 = 0 then 'NRPS' when p_size % 7 = 0 then 'Type I Iterative PKS' end as st from part),
 h as (select *, coalesce(case st when 'NRPS' then 'Nonribosomal Peptide Synthase (NRPS)' when 'Type I Iterative PKS' then 'Type I Iterative Polyketide synthase (PKS)' end, bb) as h from b)
 select p_partkey, case h when 'none' then null when 'terpene' then 'terpene cyclase' when 'other' then 'putative secondary metabolism biosynthetic enzyme' when 'indole' then 'aromatic prenyltransferase (DMATS family)'
  when 'putative' then 'putative uncategorized biosynthetic cluster' else case when h = 'alkaloid' or contains(h, '-') then 'putative ' || h || ' biosynthetic cluster' else h end end as product from h""")
def _(t):
    kinds = F.array(*[F.lit(x) for x in ("terpene", "other", "indole", "alkaloid", "putative", "t1pks-nrps", "none", "siderophore")])
    st = F.when(F.col("p_size") % 5 == 0, "NRPS").when(F.col("p_size") % 7 == 0, "Type I Iterative PKS")
    return t.part.select("p_partkey", N.backbone_product(st, F.get(kinds, F.col("p_size") % 8)).alias("product"))


@query("f25_header_id", """select 'GEN' || (p_partkey % 7) || '_' || p_partkey as id, 'GEN' || (p_partkey % 7) as prefix from part""")
def _(t):
    h = t.part.select(F.concat(F.lit("GEN"), F.col("p_partkey") % 7, F.lit("_"), "p_partkey", F.lit(" "), "p_name").alias("header"))
    i = h.select(N.header_id(F.col("header")).alias("id"))
    return i.select("id", N.gene_prefix(F.col("id")).alias("prefix"))


@query("f26_simplify_go", """select p_partkey, case p_size % 3 when 0 then 'GO:' || p_partkey || '|GO:1' when 1 then 'GO:' || p_partkey || '|GO:1' else 'GO:1' end as terms from part""")
def _(t):
    first = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("GO:"), "p_partkey", F.lit(" "))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("GO_process: GO:"), "p_partkey", F.lit(" - x"))).otherwise("none")
    return t.part.select("p_partkey", F.array_join(N.simplify_go(F.array(first, F.lit("GO:1"))), "|").alias("terms"))


@query("f27_clean_notes", """select p_partkey, case when p_size % 2 = 0 then 'COG:' || p_size || '|COG:b.c|plain' else p_name || 'x|plain' end as notes from part""")
def _(t):
    first = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("COG:"), "p_size", F.lit(",b;c"))).otherwise(F.concat("p_name", F.lit(",x")))
    return t.part.select("p_partkey", F.array_join(N.clean_notes(F.array(first, F.lit("pl,ain"))), "|").alias("notes"))


@query("f29_rewrite_tags", """select p_partkey, replace(p_name || '_OLD' || p_partkey, 'OLD', 'NEW') as tag from part""")
def _(t):
    return t.part.select("p_partkey", N.rewrite_tag(F.concat("p_name", F.lit("_OLD"), "p_partkey"), "OLD", "NEW").alias("tag"))


@query("f31_short_species", """select p_partkey, case when p_size % 3 = 0 then 'Gen_sp' else substr(p_name, 1, 1) || '. ' || split_part(p_name, ' ', 2) || case when p_size % 2 = 0 then ' iso' || p_size else '' end end as label from part""")
def _(t):
    name = F.when(F.col("p_size") % 3 == 0, "Gen_sp").otherwise(F.col("p_name"))
    iso = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("iso"), "p_size"))
    return t.part.select("p_partkey", N.short_species(name, iso).alias("label"))


@query("f32_variant_product", """select distinct l_orderkey, l_linenumber, 'kinase' || case when l_linenumber > 1 then ', variant ' || l_linenumber else '' end as product from lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", N.variant_product(F.lit("kinase"), F.col("l_linenumber")).alias("product")).distinct()


@query("f33_render_missing", """select l_orderkey, p_partkey, coalesce(case when p_size > 25 then p_name end, '*') as cell from (select distinct l_orderkey, l_partkey from lineitem) left join part on l_partkey = p_partkey""")
def _(t):
    li = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    return li.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left").select("l_orderkey", "p_partkey", N.render_missing(F.when(F.col("p_size") > 25, F.col("p_name")), "*").alias("cell"))


@query("p16_drop_models", """select o_orderkey as gene_id from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity = 50)""")
def _(t):
    return A.drop_models(t.orders.select(F.col("o_orderkey").alias("gene_id")), t.lineitem.where("l_quantity = 50").select(F.col("l_orderkey").alias("gene_id")))


@query("u9_except_ids", """select l_orderkey as gene_id from lineitem where l_quantity = 50 except select o_orderkey from orders where o_orderstatus = 'F'""")
def _(t):
    return A.except_ids(t.lineitem.where("l_quantity = 50").select(F.col("l_orderkey").alias("gene_id")),
                        t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("gene_id")), "gene_id")


@query("p4_unknown_contigs", """select distinct l_suppkey as contig from lineitem where l_suppkey not in (select s_suppkey from supplier where s_nationkey < 20)""")
def _(t):
    return A.except_ids(t.lineitem.select(F.col("l_suppkey").alias("contig")), t.supplier.where("s_nationkey < 20").select(F.col("s_suppkey").alias("contig")), "contig")


@query("j15_missing_transcripts", """select o_orderkey as tx_id from orders except select l_orderkey from lineitem""")
def _(t):
    return A.except_ids(t.orders.select(F.col("o_orderkey").alias("tx_id")), t.lineitem.select(F.col("l_orderkey").alias("tx_id")), "tx_id")


@query("u8_carry_products", """select o_orderkey as gene_id, coalesce(p_name, case when o_orderkey % 2 = 0 then 'kept' end, 'hypothetical protein') as product from orders left join (select * from part where p_size > 20) on p_partkey = o_orderkey""")
def _(t):
    m = t.orders.select(F.col("o_orderkey").alias("gene_id"), F.when(F.col("o_orderkey") % 2 == 0, "kept").alias("product"))
    return A.carry_products(m, t.part.where("p_size > 20").select(F.col("p_partkey").alias("gene_id"), F.col("p_name").alias("product")))


@query("u11_merged_locus_name", """select o_orderkey, case when o_orderkey % 3 = 0 then 'FUN_' || o_orderkey when o_orderkey % 3 = 1 then 'FUN_' || o_orderkey else 'XX_' || o_orderkey end as locus from orders""")
def _(t):
    k = F.col("o_orderkey")
    n = F.when(k % 3 == 0, F.concat(F.lit("FUN_"), k, F.lit("_FUN_"), k + 1)).when(k % 3 == 1, F.concat(F.lit("FUN_"), k)).otherwise(F.concat(F.lit("XX_"), k))
    return t.orders.select(k, N.merged_locus_name(n, "FUN").alias("locus"))


@query("p17_valid_ec", f"""with a as (select id, ref_db, case when ref_db = 'EC_number' then '1.2.' || value || case when event_id % 3 = 0 then '.n' when event_id % 3 = 1 then '.7' else '' end else value end as value from ({V.ANNOTS.split('as (', 1)[1]}),
 nm as (select distinct split_part(id, '-T', 1) as g from a where ref_db = 'name') select * from a where ref_db <> 'EC_number' or (regexp_full_match(value, '\\d+\\.\\d+\\.\\d+\\.(\\d+|n|-)') and split_part(id, '-T', 1) in (select g from nm))""")
def _(t):
    a = V.annots(t)
    v = F.when(F.col("ref_db") == "EC_number", F.concat(F.lit("1.2."), "value", F.when(F.col("event_id") % 3 == 0, ".n").when(F.col("event_id") % 3 == 1, ".7").otherwise(""))).otherwise(F.col("value"))
    return A.ec_with_gene(a.select("id", "ref_db", v.alias("value")))
