"""Graph and enrichment operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..scale import Slabs, materialize


def go_closure(edges: DataFrame, max_rounds: int = 12) -> DataFrame:
    """All (node, ancestor) pairs by path doubling.

    Round k has all pairs up to 2^k steps apart and hangs them under those just 2^k steps apart, which is
    the one place where a shortest way of up to twice that length is cut. Each pair is written once.
    """
    pairs = materialize(edges.select("node", "ancestor").distinct().withColumn("steps", F.lit(1)), "closure")
    parts, reach = [pairs], 1
    for _ in range(max_rounds):
        ends = parts[-1].where(F.col("steps") == reach).select("node", F.col("ancestor").alias("_m"))
        ways = pairs.select(F.col("node").alias("_m"), "ancestor", (F.col("steps") + reach).alias("steps"))
        grown = ends.join(ways, "_m").groupBy("node", "ancestor").agg(F.min("steps").alias("steps"))
        # a pair may have a shorter way; where each node has one parent at most there is none
        parts.append(materialize(grown.join(pairs, ["node", "ancestor"], "left_anti"), "closure"))
        if parts[-1].isEmpty():
            return pairs.select("node", "ancestor")
        pairs, reach = pairs.unionByName(parts[-1]), 2 * reach
    raise RuntimeError("closure did not settle; raise max_rounds")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction step: hang neighbours under the least label around a node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    j = both.join(low, "u")
    if large:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` with the least node as label.

    Alternates large-star and small-star contraction, which needs a logarithmic
    number of rounds in practice. No neighbour list is collected: hubs are an
    aggregate plus an equi-join, and each round's edges are written out.
    Nodes are numbered in their own order first: least numbers are found by hashing, least texts only by sorting.
    """
    edges = materialize(edges.select("u", "v").distinct(), "edges")
    nodes = materialize(edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct(), "nodes")
    nodes = materialize(nodes.orderBy("node").withColumn("id", F.monotonically_increasing_id()), "nodes")
    number = lambda c: nodes.select(F.col("node").alias(c), F.col("id").alias(f"_{c}"))
    cur = materialize(edges.where("u != v").join(number("u"), "u").join(number("v"), "v").select(F.col("_u").alias("u"), F.col("_v").alias("v")), "edges")
    mark = None
    for _ in range(max_rounds):
        cur = materialize(_star(_star(cur, True), False), "edges")
        now = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    first = nodes.select(F.col("id").alias("v"), F.col("node").alias("component"))
    named = nodes.join(cur.withColumnRenamed("u", "id"), "id", "left").withColumn("v", F.coalesce("v", "id"))
    return named.join(first, "v").select("node", "component")


def group_loci(transcripts: DataFrame, frac: float = 0.3, keys=("contig",)) -> DataFrame:
    """Transcripts linked when one covers ``frac`` of the other's (half-open) length.

    Copies of a span fold first. Take from a span what it needs to share, ``need = ceil(frac * length)``,
    at both of its ends and its core is left. Up to ``frac`` 0.5 a pair is linked exactly where one span
    meets the core of the other: what meets a core shares ``need`` with its span, or lies inside it whole.
    Spans that start in a core hang together, and so do the cores that start in a span, so neighbours in
    order of place belong to one run where a running maximum shows a core or span over both. That leaves at
    most three links between runs for each span, however many overlap. Above 0.5, overlapping pairs are
    compared. A span of length 0 is a locus of its own.
    """
    keys = list(keys)
    spans = transcripts.select(*keys, "start", "end").distinct()
    if frac <= 0.5:
        out = _run_loci(spans, frac, keys)
    else:
        named = spans.withColumn("span", _span_name(keys, F.struct("start", "end")))
        comp = components(_shared_edges(named.where("end > start"), frac, keys))
        out = named.join(comp, F.col("span") == F.col("node"), "left").select(*keys, "start", "end", F.coalesce("component", "span").alias("locus"))
    return transcripts.join(out, keys + ["start", "end"])


def _span_name(keys: list[str], span: Column) -> Column:
    return F.concat_ws(":", *keys, F.format_string("%019d", span["start"]), F.format_string("%019d", span["end"]))


def _run_loci(spans: DataFrame, frac: float, keys: list[str]) -> DataFrame:
    """Distinct spans with their ``locus``. Only islands of overlapping spans that hold several runs reach the
    graph; a lone run is its island's locus, and on sparse data nearly all are."""
    runs = _core_runs(spans.where("end > start"), frac, keys)
    island = W.partitionBy(*keys, "island")
    runs = materialize(runs.withColumn("open", F.min("run").over(island) != F.max("run").over(island)), "runs")
    name = lambda c: _span_name(keys, F.col(c))
    behind = lambda c: F.concat(F.lit(chr(0x10FFFF)), name(c))
    tied = runs.where("open").select(*keys, "start", "end", name("run").alias("run"), *[F.when(F.col(c).isNotNull(), n(c)).alias(c) for c, n in (("own", behind), ("met", behind), ("inner", name))])
    joined = tied.join(components(_run_links(tied)), F.col("run") == F.col("node"), "left").select(*keys, "start", "end", F.coalesce("component", "run").alias("locus"))
    alone = runs.where("not open").select(*keys, "start", "end", name("run").alias("locus"))
    rest = spans.where("end <= start").select(*keys, "start", "end", _span_name(keys, F.struct("start", "end")).alias("locus"))
    return joined.unionByName(alone).unionByName(rest)


def _shared_edges(named: DataFrame, frac: float, keys: list[str]) -> DataFrame:
    """Pairs of spans of which one shares ``frac`` of the other's length."""
    from .intervals import overlap_join
    shared = F.greatest(F.least("end", "b_end") - F.greatest("start", "b_start"), F.lit(0))
    near = (shared >= (F.col("end") - F.col("start")) * frac) | (shared >= (F.col("b_end") - F.col("b_start")) * frac)
    edges = overlap_join(named, named, keys, extra=near & (F.col("span") < F.col("b_span")))
    return edges.select(F.col("span").alias("u"), F.col("b_span").alias("v"))


# kinds of marks: starts precede ends of the same place
CORE, CORE_END, SPAN, SPAN_END = range(4)


def _core_runs(spans: DataFrame, frac: float, keys: list[str]) -> DataFrame:
    """Spans with the ``run`` of their start, and what hangs together with it: ``own`` run of its core, ``met`` run of
    cores at its end, ``inner`` run of spans at its core's end (null where none is met), and the ``island`` of
    overlapping spans.

    A run is named by its first span, which is its least one.
    Places are doubled: ends of spans are even, ends of cores odd, so a span and a core never tie.
    """
    need = F.ceil((F.col("end") - F.col("start")) * F.lit(frac)).cast("long")
    low, high, core_low, core_high = 2 * F.col("start"), 2 * F.col("end"), 2 * (F.col("start") + need) - 1, 2 * (F.col("end") - need) + 1
    marks = F.array(*[F.struct(F.lit(kind).alias("kind"), at.alias("at"), other.alias("other")) for kind, at, other in
                      ((SPAN, low, high), (CORE, core_low, core_high), (SPAN_END, high, low), (CORE_END, core_high, core_low))])
    events = spans.select(*keys, "start", "end", F.explode(marks).alias("m")).select(*keys, "start", "end", "m.*")
    line = Slabs(events, keys, ["at", "kind", "start", "end"])
    only = lambda kind, v: F.when(F.col("kind") == kind, v)
    line.scan(("_spans", "max", only(SPAN, F.col("other")), True), ("_cores", "max", only(CORE, F.col("other")), True), ("_before", "max", only(SPAN, F.col("other")), False))
    if not line.single:
        line.df = materialize(line.df, "line")  # each scan of slabs reads its input twice
    # how far the cores reached at the last span, and the spans at the last core
    last = lambda kind, reach: only(kind, F.struct(F.col("at").alias("at"), F.col(reach).alias("reach")))
    line.scan(("_span", "last", last(SPAN, "_cores"), False), ("_core", "last", last(CORE, "_spans"), False))
    if not line.single:
        line.df = materialize(line.df, "line")
    goes_on = lambda seen: F.coalesce(F.col(seen)["reach"] >= F.col("at"), F.lit(False))
    opens = F.coalesce(F.col("_before") < F.col("at"), F.lit(True))
    me = F.struct("start", "end")
    line.scan(("_run", "last", only(SPAN, F.when(~goes_on("_span"), me)), True), ("_core_run", "last", only(CORE, F.when(~goes_on("_core"), me)), True),
              ("_island", "last", only(SPAN, F.when(opens, F.col("at"))), True))
    # an end meets the last start of the other kind if that lies behind its own start
    return line.result().groupBy(*keys, "start", "end").agg(
        F.max(only(SPAN, F.col("_run"))).alias("run"), F.max(only(CORE, F.col("_core_run"))).alias("own"),
        F.max(only(SPAN_END, F.when(F.col("_core.at") >= F.col("other"), F.col("_core_run")))).alias("met"),
        F.max(only(CORE_END, F.when(F.col("_span.at") >= F.col("other"), F.col("_run")))).alias("inner"), F.max(only(SPAN, F.col("_island"))).alias("island"))


def _run_links(runs: DataFrame) -> DataFrame:
    """At most three links between runs for each span; runs of cores sort behind all spans."""
    pairs = F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in (("run", "own"), ("run", "met"), ("own", "inner"))])
    return runs.select(F.explode(pairs).alias("p")).select("p.*").dropna()


def log_factorial(n: Column) -> Column:
    """ln n! as an expression: exact sums up to 20, Stirling's series (error below 1e-15) beyond."""
    exact = F.get(F.array(*[F.lit(math.lgamma(i + 1)) for i in range(21)]), F.least(n, F.lit(20)).cast("int"))
    x = F.greatest(n, F.lit(20)) + F.lit(1.0)
    inv = F.lit(1.0) / x
    series = inv / 12 - F.pow(inv, 3) / 360 + F.pow(inv, 5) / 1260 - F.pow(inv, 7) / 1680
    return F.when(n <= 20, exact).otherwise((x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series)


def likely_counts(n: Column, kk: Column, nn: Column) -> Column:
    """Counts whose chance is not 0 in double precision: Bernstein's bound, which holds for draws without
    return too, has all others below exp(-760). They grow with the square root of the population."""
    mean, share, drawn = n * kk / nn, kk / nn, n / nn
    far = F.lit(254) + F.sqrt(F.lit(254.0**2) + 1520 * F.least(n * share * (1 - share), kk * drawn * (1 - drawn)))
    return F.sequence(F.greatest(F.lit(0).cast("long"), n + kk - nn, F.ceil(mean - far)), F.least(n, kk, F.floor(mean + far)))


def fisher_p(k: Column, n: Column, kk: Column, nn: Column) -> Column:
    """Exact two-sided hypergeometric p-value: k of n in study, kk of nn in population.

    Sums the chances of all counts that are no likelier than ``k``, inside the JVM.
    """
    base = log_factorial(kk) + log_factorial(nn - kk) + log_factorial(n) + log_factorial(nn - n) - log_factorial(nn)
    chance = lambda i, b: b - log_factorial(i) - log_factorial(kk - i) - log_factorial(n - i) - log_factorial(nn - kk - n + i)
    counts = likely_counts(n, kk, nn)
    # arrays of one element keep the figures that do not change along the sum computed once
    known = F.transform(F.array(base), lambda b: F.struct(b.alias("b"), (chance(k, b) + 1e-7).alias("ref")))

    def total(f):
        logs = F.transform(counts, lambda i: chance(i, f["b"]))
        return F.aggregate(logs, F.lit(0.0), lambda acc, v: acc + F.when(v <= f["ref"], F.exp(v)).otherwise(0.0))

    return F.least(F.lit(1.0), F.get(F.transform(known, total), F.lit(0)))


def go_enrichment(study: DataFrame, assoc: DataFrame, max_fdr: float = 0.05) -> DataFrame:
    """Fisher's exact test per (genome, term) against the whole population, BH-corrected.

    ``study(genome, gene_id)`` are the genes of interest, ``assoc(gene_id, term)`` covers the
    population. Only term counts reach the p-value function.
    """
    a = assoc.select("gene_id", "term").distinct()
    pop_n = a.agg(F.count_distinct("gene_id")).scalar()
    pop = a.groupBy("term").agg(F.count(F.lit(1)).alias("pop_count"))
    s = study.select("genome", "gene_id").distinct().join(a.select("gene_id").distinct(), "gene_id", "left_semi")
    size = s.groupBy("genome").agg(F.count(F.lit(1)).alias("study_n"))
    hit = s.join(a, "gene_id").groupBy("genome", "term").agg(F.count(F.lit(1)).alias("study_count"))
    t = hit.join(size, "genome").join(pop, "term").withColumn("pop_n", pop_n)
    # few rows, much work in each: no coalescing into a few tasks
    t = t.repartition(4 * t.sparkSession.sparkContext.defaultParallelism, "genome", "term")
    t = materialize(t.withColumn("p", fisher_p(*[F.col(c) for c in ("study_count", "study_n", "pop_count", "pop_n")])), "fisher")
    tests = t.groupBy("genome").agg(F.count(F.lit(1)).alias("m"))
    ranked = Slabs(t.join(tests, "genome"), ["genome"], [F.col("p").desc(), "term"])
    ranked.scan(("_down", "sum", F.lit(1).cast("long"), True))
    raw = F.col("p") * F.col("m") / (F.col("m") - F.col("_down") + 1)
    ranked.scan(("_neg", "max", -F.least(raw, F.lit(1.0)), True))
    out = ranked.result().withColumn("fdr", -F.col("_neg"))
    over = F.col("study_count") / F.col("study_n") > F.col("pop_count") / F.col("pop_n")
    return (out.where(F.col("fdr") <= max_fdr).withColumn("direction", F.when(over, "over").otherwise("under"))
            .select("genome", "term", "study_count", "study_n", "pop_count", "pop_n", "p", "fdr", "direction"))
