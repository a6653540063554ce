"""Key-value annotations ``(id, ref_db, value)`` in long form, their merges and overrides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import naming as N
from ..functions.sequence import natural_key
from ..scale import Slabs, number_rows

# Kinds that belong to the gene instead of the transcript.
GENE_KINDS = ["name", "product"]


def union_annotations(*frames: DataFrame) -> DataFrame:
    """All sources as one set of rows with the number of copies seen."""
    cols = ["id", "ref_db", "value"]
    both = reduce(lambda a, b: a.unionByName(b), [f.select(cols) for f in frames])
    return both.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))


def valid_annotations(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """Ids that start with a known gene prefix and non-empty values."""
    known = reduce(lambda a, b: a | b, [F.col("id").startswith(p) for p in prefixes])
    return df.where(known & F.col("value").isNotNull())


def gene_key(id_: Column, ref_db: Column, kinds=GENE_KINDS) -> Column:
    """``gene-T1`` to ``gene`` for gene-level kinds, unchanged otherwise."""
    return F.when(ref_db.isin(*kinds) & id_.contains("-T"), F.substring_index(id_, "-T", 1)).otherwise(id_)


def key_annotations(annotations: DataFrame, tx2gene: DataFrame | None = None, kinds=GENE_KINDS) -> DataFrame:
    """A16 keys: names and products to genes (by table when given), empty values dropped."""
    df = annotations.where(F.col("value") != "")
    if tx2gene is None:
        return df.withColumn("id", gene_key(F.col("id"), F.col("ref_db"), kinds))
    look = (tx2gene.select(F.col("tx_id").alias("_t"), F.col("gene_id").alias("_g")))
    j = df.join(look, (F.col("id") == F.col("_t")) & F.col("ref_db").isin(*kinds), "left")
    return j.withColumn("id", F.coalesce("_g", "id")).drop("_t", "_g")


def collect_annotations(annotations: DataFrame, tx2gene: DataFrame | None = None, order: str = "value") -> DataFrame:
    """The annotation dictionary as numbered rows ``(id, ref_db, pos, value)``.

    Long form on purpose: a hot id stays spread over many tasks.
    """
    keyed = key_annotations(annotations, tx2gene).select("id", "ref_db", "value").distinct()
    return Slabs(keyed, ["id", "ref_db"], [order]).scan(("pos", "sum", F.lit(1).cast("long"), True)).result()


def annotation_dictionary(annotations: DataFrame, tx2gene: DataFrame | None = None, sep: str = ";") -> DataFrame:
    """A16 at the edge: distinct values per (id, ref_db), sorted and joined."""
    keyed = key_annotations(annotations, tx2gene)
    return keyed.groupBy("id", "ref_db").agg(F.array_join(F.array_sort(F.collect_set("value")), sep).alias("values"))


def merge_override(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``b`` win over rows of ``a`` with the same key."""
    return a.join(b.select(*key).distinct(), key, "left_anti").unionByName(b.select(a.columns))


def apply_custom(annotations: DataFrame, custom: DataFrame, order: str = "ord") -> DataFrame:
    """Custom rows ``(id, ref_db, value, ord)`` over keyed annotations.

    The last custom name wins and earlier names become synonyms; the last custom
    product wins; all other kinds append. Synonyms are distinct and never the name.
    """
    base = key_annotations(annotations).select("id", "ref_db", "value")
    mine = key_annotations(custom, kinds=GENE_KINDS + ["gene_synonym"]).select("id", "ref_db", "value", order)
    last = (mine.where(F.col("ref_db").isin("name", "product")).groupBy("id", "ref_db")
            .agg(F.max_by("value", F.struct(order, "value")).alias("value")))
    replaced = last.select("id", "ref_db")
    old_names = base.where("ref_db = 'name'").unionByName(mine.where("ref_db = 'name'").select("id", "ref_db", "value"))
    demoted = (old_names.join(replaced, ["id", "ref_db"], "left_semi").withColumn("ref_db", F.lit("gene_synonym")))
    kept = base.join(replaced, ["id", "ref_db"], "left_anti")
    extra = mine.where(~F.col("ref_db").isin("name", "product")).select("id", "ref_db", "value")
    rows = kept.unionByName(last).unionByName(extra).unionByName(demoted)
    syn = rows.where("ref_db = 'gene_synonym'").distinct()
    names = rows.where("ref_db = 'name'").select("id", "value").distinct()
    return rows.where("ref_db != 'gene_synonym'").unionByName(syn.join(names, ["id", "value"], "left_anti").select("id", "ref_db", "value"))


def apply_fixes(annotations: DataFrame, fixes: DataFrame, removes: DataFrame) -> DataFrame:
    """Fixes ``(id, name, product)`` replace names and products of known ids; removes drop both."""
    known = annotations.select("id").distinct()
    fix = fixes.join(known, "id", "left_semi")
    rows = fix.select("id", F.expr("stack(2, 'name', name, 'product', product) as (ref_db, value)"))
    merged = merge_override(annotations.select("id", "ref_db", "value"), rows, ["id", "ref_db"])
    gone = removes.select("id").distinct().withColumn("_gone", F.lit(True))
    return (merged.join(gone, "id", "left")
            .where(F.col("_gone").isNull() | ~F.col("ref_db").isin("name", "product")).drop("_gone"))


def suffix_duplicates(names: DataFrame, order: str = "id") -> DataFrame:
    """A name shared by several genes becomes ``name_1 .. name_n`` in natural order of the id."""
    gene = F.when(F.col("id").contains("-T"), F.substring_index("id", "-T", 1)).otherwise(F.col("id"))
    shared = names.groupBy("name").agg(F.count_distinct(gene).alias("_g"))
    keyed = names.withColumn("_key", natural_key(F.col(order)))
    numbered = Slabs(keyed, ["name"], ["_key", order]).scan(("_i", "sum", F.lit(1).cast("long"), True)).result().drop("_key")
    return numbered.join(shared, "name").withColumn(
        "final_name", F.when(F.col("_g") > 1, F.concat("name", F.lit("_"), "_i")).otherwise(F.col("name"))).drop("_i", "_g")


def lookup_curated(names: DataFrame, curated: DataFrame, name: str = "name") -> DataFrame:
    """Curated product by exact name, else by lower-case name; ``curated_exact`` tells which."""
    exact = (curated.select(F.col("name").alias("_n1"), F.col("product").alias("_p1")))
    lower = (curated.select(F.col("name").alias("_n2"), F.col("product").alias("_p2")))
    j = names.join(exact, F.col(name) == F.col("_n1"), "left").join(lower, F.lower(name) == F.col("_n2"), "left")
    j = j.withColumns({"curated_product": F.coalesce("_p1", "_p2"), "curated_exact": F.col("_p1").isNotNull()})
    return j.drop("_n1", "_p1", "_n2", "_p2")


def choose_product(candidates: DataFrame, curated: DataFrame) -> DataFrame:
    """The last curated candidate wins, else the first source; one aggregate per id.

    ``curated`` is set for exact names only: one found in lower case may still be a sentence.
    """
    c = lookup_curated(candidates, curated)
    is_cur = F.col("curated_product").isNotNull()
    exact = F.col("curated_exact")
    rank = F.struct(F.when(is_cur, 0).otherwise(1).alias("a"), F.when(is_cur, -F.col("ord")).otherwise(F.col("ord")).alias("b"), "name")
    pick = F.min_by(F.struct("name", F.coalesce("curated_product", "product").alias("product"), exact.alias("curated")), rank)
    return c.groupBy("id").agg(pick.alias("m")).select("id", "m.*")


def name_products(candidates: DataFrame, curated: DataFrame) -> DataFrame:
    """O15 + F18: chosen name with its cleaned product, and whether it needs curating."""
    chosen = choose_product(candidates, curated)
    named = N.add_clean_product(chosen.withColumnRenamed("product", "original"), "original", "name", "curated", "product")
    return named.select("id", "name", "product", "original", "curated", "need_curating")


def curation_reports(products: DataFrame, failed: DataFrame, curated: DataFrame) -> DataFrame:
    """Must-fix (failed), need-curating (sentence fallback), and passed names outside the curated list."""
    bad = failed.select("name").distinct().withColumn("_f", F.lit(True))
    cur = curated.select("name").distinct().withColumn("_c", F.lit(True))
    j = products.join(bad, "name", "left").join(cur, "name", "left").where("_c is null")
    status = F.when(F.col("_f"), "must_fix").when(F.col("need_curating"), "need_curating").otherwise("passed")
    return j.withColumn("report", status).drop("_f", "_c")


def route_notes(annotations: DataFrame) -> DataFrame:
    """Every known prefix to its channel with the bare value; COG letters one per row."""
    prefix = F.when(F.col("value").contains(":"), F.substring_index("value", ":", 1))
    rest = F.substring(F.col("value"), F.length(prefix) + 2, F.length("value"))
    known = F.when(F.col("ref_db") == "db_xref", prefix.isin(*N.XREF_PREFIXES)).when(F.col("ref_db") == "note", prefix.isin(*N.NOTE_PREFIXES)).otherwise(False)
    routed = annotations.withColumn("channel", F.when(known, prefix).otherwise(F.lit("other"))).withColumn(
        "hit", F.when(known, rest).otherwise(F.col("value")))
    return routed.withColumn("hit", F.explode_outer(F.when(F.col("channel") == "COG", F.split("hit", ",")).otherwise(F.array("hit"))))


def note_headers(annotations: DataFrame) -> DataFrame:
    """Prefixes present in notes, smCOG ones left out."""
    return (annotations.where((F.col("ref_db") == "note") & F.col("value").contains(":"))
            .select(F.substring_index("value", ":", 1).alias("header")).where(~F.col("header").startswith("SMCOG")).distinct())


def distinct_terms(annotations: DataFrame, prefix: str = "InterPro") -> DataFrame:
    """A34."""
    return (annotations.where((F.col("ref_db") == "db_xref") & F.col("value").startswith(prefix + ":"))
            .select(F.substring_index("value", ":", -1).alias("term")).distinct())


def invert(df: DataFrame, key: str, value: str, sep: str = ";") -> DataFrame:
    """Value to its keys."""
    return df.groupBy(value).agg(F.array_join(F.array_sort(F.collect_set(F.col(key).cast("string"))), sep).alias(f"{key}s"))


def flip_first(df: DataFrame, key: str, value: str) -> DataFrame:
    """Value to its first key."""
    return df.groupBy(value).agg(F.min(key).alias(key))


def with_descriptions(df: DataFrame, lookup: DataFrame, term: str = "term", default: str = "No description") -> DataFrame:
    """Left join on a lookup table; hints a broadcast only below a size limit."""
    look = (lookup.select(F.col("term").alias("_t"), F.col("description").alias("_d")))
    return df.join(look, F.col(term) == F.col("_t"), "left").withColumn("description", F.coalesce("_d", F.lit(default))).drop("_t", "_d")


def go_category(df: DataFrame, terms: DataFrame) -> DataFrame:
    """Qualifier line per GO id; alternative ids resolve to their main term; unknown ids drop."""
    main = terms.select(F.col("go_id").alias("_id"), "name", "namespace")
    alts = terms.select(F.explode_outer("alt_ids").alias("_id"), "name", "namespace").where("_id is not null")
    look = (main.unionByName(alts))
    kind = F.create_map(*[F.lit(x) for kv in N.GO_QUALIFIERS.items() for x in kv])
    return (df.join(look, F.col("go_id") == F.col("_id")).withColumn("qualifier", kind[F.col("namespace")])
            .withColumn("line", F.concat("qualifier", F.lit("\t"), "name", F.lit("|"), F.replace("go_id", F.lit("GO:"), F.lit("")), F.lit("||IEA")))
            .drop("_id"))


def go_associations(annotations: DataFrame) -> DataFrame:
    """``;``-joined distinct GO ids per gene."""
    go = annotations.where(F.col("value").startswith("GO"))
    return go.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("value")), ";").alias("terms"), F.count_distinct("value").alias("n_terms"))


def merge_secretome(phobius: DataFrame, signalp: DataFrame | None) -> DataFrame:
    """Membrane notes from Phobius; secretion from SignalP when given, else from Phobius."""
    mem = phobius.where("tm > 0").select("id", N.membrane_note(F.col("tm"), F.col("prediction")).alias("value"))
    if signalp is None:
        site = F.substring_index(F.substring_index("prediction", "/", 1), "c", -1)
        sec = phobius.where("sp = 'Y'").select("id", N.signal_note(site, F.lit(""), F.lit("")).alias("value"))
    else:
        sec = signalp.select("id", N.signal_note(F.col("end"), F.col("cut"), F.col("prob")).alias("value"))
    return mem.unionByName(sec).withColumn("ref_db", F.lit("note")).select("id", "ref_db", "value")


def eggnog_annotations(rows: DataFrame, prefix: str = "ENOG50") -> DataFrame:
    """F20 for the current layout: ``(query, ogs, tax, symbol, cogs, ec, description)`` to triples.

    The group of the best tax level becomes the NOG; rows without any group only keep
    their EC number; symbols that pass P8 add a name and the head of the description.
    """
    clean = rows.select(*[F.when(F.col(c) == "-", "").otherwise(F.col(c)).alias(c) for c in rows.columns])
    og = F.filter(F.split("ogs", ","), lambda x: F.substring_index(x, "@", -1) == F.col("tax"))
    nog = F.concat(F.lit(prefix), F.coalesce(F.substring_index(F.element_at(F.when(F.size(og) > 0, og), -1), "@", 1), F.lit("")))
    d = clean.select("query", nog.alias("nog"), N.common_ec_prefix(F.col("ec")).alias("ec"), N.spaced_letters(F.col("cogs")).alias("cogs"),
                     F.when(N.valid_symbol(F.col("symbol")), F.col("symbol")).alias("symbol"), F.substring_index("description", ". ", 1).alias("head"))
    parts = F.array(
        F.struct(F.lit("EC_number").alias("ref_db"), F.when(F.col("ec") != "", F.col("ec")).alias("value")),
        F.struct(F.lit("note").alias("ref_db"), F.concat(F.lit("EggNog:"), "nog").alias("value")),
        F.struct(F.lit("note").alias("ref_db"), F.when(F.col("cogs") != "", F.concat(F.lit("COG:"), "cogs")).alias("value")),
        F.struct(F.lit("name").alias("ref_db"), F.col("symbol").alias("value")),
        F.struct(F.lit("product").alias("ref_db"), F.when(F.col("symbol").isNotNull(), F.col("head")).alias("value")))
    return d.select(F.col("query").alias("id"), F.explode_outer(parts).alias("a")).select("id", "a.*").where("value is not null")


def drop_models(models: DataFrame, ids: DataFrame, key: str = "gene_id") -> DataFrame:
    """P16."""
    return models.join(ids.select(key).distinct(), key, "left_anti")


def except_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct ids of ``a`` that ``b`` does not have."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


def carry_products(models: DataFrame, products: DataFrame, default: str = "hypothetical protein") -> DataFrame:
    """U8: known products move onto new loci."""
    known = products.select("gene_id", F.col("product").alias("_p"))
    return models.join(known, "gene_id", "left").withColumn("product", F.coalesce("_p", "product", F.lit(default))).drop("_p")


def ec_with_gene(annotations: DataFrame) -> DataFrame:
    """EC numbers need four levels and a named gene; other kinds pass."""
    named = annotations.where("ref_db = 'name'").select(gene_key(F.col("id"), F.col("ref_db")).alias("_gene")).distinct()
    gene = F.when(F.col("id").contains("-T"), F.substring_index("id", "-T", 1)).otherwise(F.col("id"))
    ecs = annotations.where(F.col("ref_db") == "EC_number").where(N.valid_ec(F.col("value")))
    ok = ecs.join(named, gene == F.col("_gene"), "left_semi")
    return annotations.where("ref_db != 'EC_number'").unionByName(ok)


def number_values(df: DataFrame, order: list, keys: list[str]) -> DataFrame:
    return number_rows(df, order, "pos", keys)
