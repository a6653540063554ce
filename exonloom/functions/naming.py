"""Text rules for names, products, notes and cross references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import computed_once

# Organisms whose names are removed from product texts.
MODEL_ORGANISMS = r"(?:Saccharomyces\s+cerevisiae|Candida\s+albicans|Aspergillus\s+(?:nidulans|fumigatus)|Cryptococcus\s+neoformans)"

# Ordered clean-up rules of product texts (pattern, replacement).
PRODUCT_RULES = [
    (r"(?i)\bpotential\b", "putative"),
    (r"(?i)\bpossible\b", "putative"),
    (r"(?i)\bprobable\b", "putative"),
    (r"(?i)\bpredicted\b", "putative"),
    (r"(?i)\buncharacterised\b", "uncharacterized"),
    (r"(?i)\bhomolog(?:ous|ues?|s)?\s+(?:to|of)\s+" + MODEL_ORGANISMS + r"\s+(\S+)", "Protein $1"),
    (r"(?i)\bortholog(?:ous|ues?|s)?\s+(?:to|of)\s+" + MODEL_ORGANISMS + r"\s+(\S+)", "Protein $1"),
    (r"(?i)\bsimilar to\s+" + MODEL_ORGANISMS + r"\s+(\S+)", "Protein $1"),
    (r"(?i)\bhomolog(?:ous|ues?|s)?\s+(?:to|of)\s+", ""),
    (r"(?i)\bortholog(?:ous|ues?|s)?\s+(?:to|of)\s+", ""),
    (r"(?i)\bhomolog(?:ues?|s)?\b", ""),
    (r"(?i)\bortholog(?:ues?|s)?\b", ""),
    (r"(?i)\bsimilar to\b", ""),
    (r"(?i)" + MODEL_ORGANISMS, ""),
    (r"(?i)\byeast\b", ""),
    (r"(?i)\bhuman\b", ""),
    (r"(?i)\bmurine\b", ""),
    (r"(?i)\bmouse\b", ""),
    (r"(?i)\bDrosophila\b", ""),
    (r"(?i)\bnovel\b", ""),
    (r"(?i)\bfragment\b", ""),
    (r"(?i)\bpartial\b", ""),
    (r"(?i)\btruncated\b", ""),
    (r"(?i)\bdubious\b", ""),
    (r"(?i)\bdoubtful\b", ""),
    (r"(?i)\bexpressed\b", ""),
    (r"(?i)\bsecreted\b", ""),
    (r"\bWGS\b", ""),
    (r"\bORF\b", ""),
    (r"(?i)\bconserved\b(?!\s+domain)", ""),
    (r"(?i)\bprotein of unknown function\b", "hypothetical protein"),
    (r"(?i)\bconserved hypothetical\b", ""),
    (r"(?i)\bhypothetical conserved\b", ""),
    (r"(?i)\bcell surface\b", ""),
    (r"(?i)\bsurface antigen\b", ""),
    (r"(?i)\binvolved in\b", ""),
    (r"(?i)\bimplicated in\b", ""),
    (r"(?i)\balso known as\b", ""),
    (r"(?i)\bopen reading frame\b", ""),
    (r"(?i)\binactivated\b", "inactive"),
    (r"\bEC(\s(\S+))?\b", ""),
    (r"\bCOG\b", ""),
    (r"\bGO\b", ""),
    (r"(?i)\binterrupt\b", ""),
    (r"(?i)\bframe ?shift\b", ""),
    (r"(?i)\bgene\b\s*$", "protein"),
    (r"(?i)^\s*(?:to|of|by|with|from|for)\s+", ""),
    (r"(?i)\bprotein\s+protein\b", "protein"),
    (r"(?i)\b(\w+ase)\s+protein\b", "$1"),
    (r"-\s*$", ""),
    (r"\bAlpha\b", "alpha"),
    (r"\bBeta\b", "beta"),
    (r"\bGamma\b", "gamma"),
    (r"\bKappa\b", "kappa"),
    (r"\bSigma\b", "sigma"),
    (r"\btype I\b", "type 1"),
    (r"\btype II\b", "type 2"),
    (r"\btype III\b", "type 3"),
    (r"\btype IV\b", "type 4"),
]

# Phrases and leading verbs that mark a sentence instead of a name.
SENTENCE_PHRASES = ["By similarity", "Required for", "Involved in", "nherit from"]
SENTENCE_VERBS = (r"(?i)^(?:binds?|activates?|inhibits?|regulates?|catalyzes?|promotes?|recruits?|mediates?|localizes?"
                  r"|phosphorylates?|cleaves?|ubiquitinates?|methylates?|acetylates?|interacts?|functions?\s+as|participates?)\s")
# Words dropped from protein descriptions.
DESCRIPTION_STOP_WORDS = ["(Fragment)", "homolog", "homolog,", "AltName:"]
# Note prefixes with a column of their own.
NOTE_PREFIXES = ["EggNog", "BUSCO", "MEROPS", "CAZy", "COG", "SECRETED", "TransMembrane", "antiSMASH"]
XREF_PREFIXES = ["PFAM", "InterPro"]
EC_PATTERN = r"^\d+\.\d+\.\d+\.(\d+|n|-)$"
# Ontology namespaces and the qualifier that reports each of them.
GO_QUALIFIERS = {"biological_process": "go_process", "molecular_function": "go_function", "cellular_component": "go_component"}
# Backbone subtypes and classes with a product text of their own.
BACKBONE_SUBTYPES = {"NRPS": "Nonribosomal Peptide Synthase (NRPS)", "Type I Iterative PKS": "Type I Iterative Polyketide synthase (PKS)"}
BACKBONE_PRODUCTS = {"terpene": "terpene cyclase", "other": "putative secondary metabolism biosynthetic enzyme",
                     "indole": "aromatic prenyltransferase (DMATS family)", "putative": "putative uncategorized biosynthetic cluster"}
BACKBONE_CLUSTERS = ["alkaloid", "lignan", "saccharide", "polyketide"]


# Texts in lower case, the first of which that stands in a rule's pattern stands in all its matches.
RULE_WORDS = ["potential", "possible", "probable", "predicted", "uncharacterised", "homolog", "ortholog", "similar to", "yeast", "human", "murine", "mouse", "drosophila", "novel",
              "fragment", "partial", "truncated", "dubious", "doubtful", "expressed", "secreted", "wgs", "orf", "conserved", "unknown function", "cell surface", "surface antigen",
              "involved in", "implicated in", "also known as", "frame", "inactivated", "ec", "cog", "interrupt", "gene", "protein", "alpha", "beta", "gamma", "kappa", "sigma", "type i"]
ORGANISM_WORDS = ["cerevisiae", "albicans", "nidulans", "fumigatus", "neoformans"]


def may_match(text: Column, pattern: str) -> Column | None:
    """A plain search that is false only where ``pattern`` cannot match; None without such a search."""
    plain = pattern.lower()
    if pattern.endswith(MODEL_ORGANISMS):
        return reduce(lambda a, b: a | b, [F.lower(text).contains(w) for w in ORGANISM_WORDS])
    word = next((w for w in RULE_WORDS if w in plain), {r"\bgo\b": "go", r"-\s*$": "-"}.get(plain))
    return None if word is None else F.lower(text).contains(word)


def replace_where(text: Column, pattern: str, by: str) -> Column:
    """Regex replacement behind a plain search; the one-element array keeps ``text`` computed once."""
    def step(v):
        found = may_match(v, pattern)
        return F.regexp_replace(v, pattern, by) if found is None else F.when(found, F.regexp_replace(v, pattern, by)).otherwise(v)

    return F.get(F.transform(F.array(text), step), F.lit(0))


def apply_rules(product: Column) -> Column:
    """The ordered rule list as one chain of JVM regex replacements."""
    return reduce(lambda c, rule: replace_where(c, *rule), PRODUCT_RULES, product)


def cap_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text)))


def symbol_product(symbol: Column) -> Column:
    return cap_first(F.concat(F.lower(symbol), F.lit("p")))


def lower_symbol(product: Column, symbol: Column) -> Column:
    return F.replace(product, symbol, F.lower(symbol))


def is_sentence(product: Column, symbol: Column) -> Column:
    found = reduce(lambda a, b: a | b, [product.contains(p) for p in SENTENCE_PHRASES])
    return (found | (product == F.concat(F.lit("protein "), symbol)) | (F.length(product) > 100) | product.rlike(SENTENCE_VERBS))


def squeeze(product: Column) -> Column:
    return F.replace(F.trim(F.regexp_replace(product, r"\s+", " ")), F.lit("()"), F.lit(""))


def close_parens(text: Column) -> Column:
    cut = F.rtrim(F.substring_index(text, "(", 1))
    text = F.when(text.contains("(") & ~text.contains(")"), cut).otherwise(text)
    return F.replace(text, F.lit(" ,"), F.lit(","))


def add_clean_product(df: DataFrame, product: str = "product", symbol: str = "name", curated: str | None = None, out: str = "clean") -> DataFrame:
    """rules, symbol in lower case, fallback to ``Symbolp`` for sentences, tidying.

    Also adds ``need_curating``: the fallback was taken. Done in steps, so that the
    long rule chain runs once per row; the symbol comes in after it.
    """
    known = F.col(curated) if curated else F.lit(False)
    ruled = computed_once(df, "_q", apply_rules(F.col(product)))
    step = computed_once(ruled, "_r", lower_symbol(F.col("_q"), F.col(symbol))).drop("_q")
    step = step.withColumn("need_curating", ~known & is_sentence(F.col("_r"), F.col(symbol)))
    text = F.when(F.col("need_curating"), symbol_product(F.col(symbol))).otherwise(F.col("_r"))
    return computed_once(step, "_t", squeeze(text)).withColumn(out, close_parens(F.col("_t"))).drop("_r", "_t")


def digit_count(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "0123456789", ""))


def valid_symbol(name: Column) -> Column:
    """No underscore, blank or dot, longer than two, and one or two digits."""
    return ~name.rlike(r"[_ .]") & (F.length(name) > 2) & digit_count(name).between(1, 2)


def valid_ec(ec: Column) -> Column:
    return F.trim(ec).rlike(EC_PATTERN)


def swissprot_product(description: Column) -> Column:
    """text before `` OS=`` without the stop words."""
    words = F.split(F.substring_index(description, " OS=", 1), " ", -1)
    stop = F.array(*[F.lit(w) for w in DESCRIPTION_STOP_WORDS])
    return F.array_join(F.filter(words, lambda w: ~F.array_contains(stop, w)), " ")


def swissprot_symbol(description: Column) -> Column:
    name = F.upper(F.substring_index(F.substring_index(description, "GN=", -1), " ", 1))
    return F.replace(name, F.lit("-"), F.lit(""))


def common_ec_prefix(ec: Column) -> Column:
    """Longest common prefix of a comma list, without trailing dots; other values as they are."""
    items = F.split(ec, ",")
    first = F.array_min(items)
    last = F.array_max(items)
    size = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.least(F.length(first), F.length(last)), F.lit(1))), F.lit(0),
        lambda acc, i: F.when((acc == i - 1) & (F.substring(first, F.lit(1), i) == F.substring(last, F.lit(1), i)), i).otherwise(acc))
    return F.when(ec.contains(","), F.rtrim(F.substring(first, F.lit(1), size), F.lit("."))).otherwise(ec)


def spaced_letters(cogs: Column) -> Column:
    """``KLT`` becomes ``K,L,T``."""
    return F.array_join(F.filter(F.split(F.replace(cogs, F.lit(" "), F.lit("")), ""), lambda c: c != ""), ",")


def backbone_product(subtype: Column, backbone: Column) -> Column:
    """product text of a biosynthetic backbone gene; null for ``none``."""
    hit = subtype
    for k, v in BACKBONE_SUBTYPES.items():
        hit = F.when(subtype == k, v).otherwise(hit)
    hit = F.coalesce(hit, backbone)
    out = F.when(hit == "none", F.lit(None).cast("string"))
    for k, v in BACKBONE_PRODUCTS.items():
        out = out.when(hit == k, v)
    wrapped = F.concat(F.lit("putative "), hit, F.lit(" biosynthetic cluster"))
    return out.when(hit.isin(*BACKBONE_CLUSTERS) | hit.contains("-"), wrapped).otherwise(hit)


def signal_note(end: Column, cut: Column, prob: Column) -> Column:
    """F22."""
    short = F.format_string("SECRETED:SignalP(1-%s)", end.cast("string"))
    return F.when(F.coalesce(cut, F.lit("")) == "", short).otherwise(
        F.format_string("SECRETED:SignalP(1-%s,cutsite=%s,prob=%s)", end.cast("string"), cut, prob.cast("string")))


def membrane_note(n: Column, layout: Column) -> Column:
    return F.format_string("TransMembrane:%s (%s)", n.cast("string"), layout)


def header_id(header: Column) -> Column:
    return F.substring_index(header, " ", 1)


def gene_prefix(gene_id: Column) -> Column:
    """base name in front of the locus number."""
    return F.when(gene_id.contains("_"), F.substring_index(gene_id, "_", 1)).otherwise(F.substring_index(gene_id, "-", 1))


def simplify_go(terms: Column) -> Column:
    """bare ids stay, ``label GO:...`` keeps its second word, other texts are dropped."""
    out = F.transform(terms, lambda x: F.when(x.startswith("GO:"), F.trim(x)).when(x.contains(" "), F.split(x, " ")[1]))
    return F.filter(out, lambda x: x.isNotNull())


def clean_notes(notes: Column) -> Column:
    """``;`` to ``.``; ``key:a,b`` to two notes; commas of plain notes removed."""
    def one(x):
        dotted = F.replace(x, F.lit(";"), F.lit("."))
        key = F.substring_index(dotted, ":", 1)
        values = F.split(F.substring(dotted, F.length(key) + 2, F.length(dotted)), ",")
        return F.when(dotted.contains(":"), F.transform(values, lambda v: F.concat(key, F.lit(":"), v))).otherwise(
            F.array(F.replace(dotted, F.lit(","), F.lit(""))))
    return F.flatten(F.transform(notes, one))


def short_species(name: Column, isolate: Column) -> Column:
    """``Genus species`` + isolate to ``G. species isolate``; names with ``_`` stay."""
    rest = F.substring(name, F.length(F.substring_index(name, " ", 1)) + 2, F.length(name))
    abbrev = F.concat(F.substring(name, 1, 1), F.lit(". "), rest)
    full = F.when(F.coalesce(isolate, F.lit("")) != "", F.concat(abbrev, F.lit(" "), isolate)).otherwise(abbrev)
    return F.when(name.contains("_"), name).otherwise(full)


def variant_product(product: Column, ordinal: Column) -> Column:
    """F32."""
    return F.when(ordinal > 1, F.concat(product, F.lit(", variant "), ordinal.cast("string"))).otherwise(product)


def rewrite_tag(value: Column, old: str, new: str) -> Column:
    """F29."""
    return F.replace(value, F.lit(old), F.lit(new))


def render_missing(value: Column, marker: str = "") -> Column:
    """F33."""
    return F.coalesce(value.cast("string"), F.lit(marker))


def merged_locus_name(name: Column, prefix: str) -> Column:
    """``P1_P2`` of merged loci becomes ``P1``."""
    mark = "_" + prefix
    return F.when(name.startswith(prefix) & name.contains(mark), F.substring_index(name, mark, 1)).otherwise(name)
