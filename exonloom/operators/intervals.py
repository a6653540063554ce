"""Interval operators over ``(contig, start, end, ...)`` with 1-based closed spans.

All-pairs overlap is a binned equi-join. Existence, containment, merging and
nearest neighbours need no pairs at all: they are running maxima over positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import Slabs, materialize

#: Bins of level ``l`` are ``16 * 8 ** l`` wide.
LEVEL = "cast(greatest(0, ceil(log(8, ({end} - {start} + 1) / 16))) as int)"


def _levels(df: DataFrame, start: str, end: str) -> Column:
    """Array of the levels that occur; a few dozen numbers at most."""
    return df.select(F.expr(LEVEL.format(start=start, end=end)).alias("l")).agg(F.collect_set("l")).scalar()


def _on_ladder(df: DataFrame, start: str, end: str, others: Column, p: str) -> DataFrame:
    """Each interval in the one or two bins of its own level, and of every higher level of the other side."""
    own = df.withColumn(f"{p}own", F.expr(LEVEL.format(start=start, end=end))).withColumn(f"{p}others", others)
    up = own.withColumn(f"{p}level", F.explode(F.expr(f"array_union(array({p}own), filter({p}others, l -> l > {p}own))"))).drop(f"{p}others")
    width = f"shiftleft(16L, 3 * {p}level)"
    return up.withColumn(f"{p}bin", F.explode(F.expr(f"sequence(floor({start} / {width}), floor({end} / {width}))")))


def overlap_join(a: DataFrame, b: DataFrame, keys=("contig",), extra: Column | None = None) -> DataFrame:
    """Every overlapping (closed) pair; columns of ``b`` come back as ``b_*``.

    A ladder of bin widths keeps a few long intervals from meeting everything: a pair meets on
    the level of its longer member, where that one fills an eighth of a bin at least. Bins crowded
    on either side are split by adaptive execution, from measured partition sizes.
    ``extra`` is a further condition over the joined columns (``start``, ``b_start`` ...).
    """
    keys = list(keys)
    b = b.select([F.col(c).alias(f"b_{c}") for c in b.columns])
    left = _on_ladder(a, "start", "end", _levels(b, "b_start", "b_end"), "_a")
    right = _on_ladder(b, "b_start", "b_end", _levels(a, "start", "end"), "_b")
    cond = (F.col("_alevel") == F.col("_blevel")) & (F.col("_abin") == F.col("_bbin"))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"b_{k}"))
    cond = cond & (F.col("start") <= F.col("b_end")) & (F.col("end") >= F.col("b_start")) & (F.col("_alevel") == F.greatest("_aown", "_bown"))
    # a pair meets in every shared bin: keep it only in the first one
    cond = cond & (F.col("_abin") == F.expr("floor(greatest(start, b_start) / shiftleft(16L, 3 * _alevel))"))
    if extra is not None:
        cond = cond & extra
    return left.join(right, cond).drop(*[f"_{s}{c}" for s in "ab" for c in ("own", "level", "bin")], *[f"b_{k}" for k in keys])


def _overlapped(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct spans of ``a`` that overlap some ``b``: the furthest end of any ``b`` that starts at or
    before their end reaches their start. Only places go through the scan, never whole rows."""
    cols = [*keys, "start", "end"]
    marks = b.groupBy(*keys, F.col("start").alias("_pos")).agg(F.max("end").alias("_bend")).withColumn("_kind", F.lit(0))
    asks = a.select(*cols).dropna().distinct().withColumn("_pos", F.col("end")).withColumn("_kind", F.lit(1))
    # marks precede asks of the same position
    reach = Slabs(asks.unionByName(marks, allowMissingColumns=True), keys, ["_pos", "_kind", "start"]).scan(("_reach", "max", F.col("_bend"), True))
    return reach.where("_kind = 1 and _reach >= start").result().select(*cols)


def overlap_semi(a: DataFrame, b: DataFrame, keys=("contig",)) -> DataFrame:
    """Rows of ``a`` that overlap at least one ``b``; no pairs are built."""
    keys = list(keys)
    return a.join(_overlapped(a, b, keys), keys + ["start", "end"], "left_semi")


def overlap_anti(a: DataFrame, b: DataFrame, keys=("contig",)) -> DataFrame:
    """Rows of ``a`` that overlap no ``b``."""
    keys = list(keys)
    return a.join(_overlapped(a, b, keys), keys + ["start", "end"], "left_anti")


def flag_overlap(a: DataFrame, b: DataFrame, name: str, keys=("contig",)) -> DataFrame:
    keys = list(keys)
    hit = _overlapped(a, b, keys).withColumn("_hit", F.lit(True))
    return a.join(hit, keys + ["start", "end"], "left").select(*a.columns, F.coalesce("_hit", F.lit(False)).alias(name))


def overlap_fraction(a: DataFrame, b: DataFrame, frac: float = 0.9, keys=("contig",),
                     merge_first: bool = False) -> DataFrame:
    """Rows of ``a`` of which a single ``b`` covers at least ``frac``.

    Both sides shrink to distinct spans first (of equal starts only the longest
    ``b`` matters), so a bin holds a bounded number of rows however many copies
    of an interval there are.
    """
    keys = list(keys)
    return a.join(covered_spans(a, b, frac, keys, merge_first), keys + ["start", "end"], "left_semi")


def covered_spans(a: DataFrame, b: DataFrame, frac: float, keys=("contig",), merge_first: bool = False) -> DataFrame:
    """Distinct spans of ``a`` of which a single ``b`` covers at least ``frac``."""
    keys = list(keys)
    reduced = merge_intervals(b, keys=keys) if merge_first else (
        b.groupBy(*keys, "start").agg(F.max("end").alias("end")))
    spans = a.select(*keys, "start", "end").distinct()
    covered = (F.least("end", "b_end") - F.greatest("start", "b_start") + 1)
    enough = covered >= F.lit(frac) * (F.col("end") - F.col("start") + 1)
    hit = overlap_join(spans, reduced.select(*keys, "start", "end"), keys, enough)
    return hit.select(*keys, "start", "end").distinct()


def merge_intervals(df: DataFrame, keys=("contig",), touching: bool = False, max_gap: int = 0) -> DataFrame:
    """Unions of overlapping spans per key.

    ``touching=False`` keeps spans that only share an end point apart, so
    ``(2,4),(4,9)`` stay two intervals; ``max_gap`` bridges gaps up to that size.
    """
    return islands(df, keys, touching, max_gap, "_isl").select(
        *keys, F.col("isl_start").alias("start"), F.col("isl_end").alias("end"))


def islands(df: DataFrame, keys=("contig",), touching: bool = False, max_gap: int = 0, name: str = "island") -> DataFrame:
    """Island number, span and member spans per key; one row per island."""
    keys = list(keys)
    spans = df.groupBy(*keys, "start").agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("_n"))
    same = F.col("start") <= F.col("_reach") + max_gap if (touching or max_gap) else F.col("start") < F.col("_reach")
    slabs = Slabs(spans, keys, ["start"]).scan(("_reach", "max", F.col("end"), False))
    slabs.scan((name, "sum", F.when(same, 0).otherwise(1).cast("long"), True))
    return slabs.result().groupBy(*keys, name).agg(
        F.min("start").alias("isl_start"), F.max("end").alias("isl_end"), F.sum("_n").alias("members"))


def assign_islands(df: DataFrame, keys=("contig",), touching: bool = False, max_gap: int = 0) -> DataFrame:
    """Adds the island number to every input row."""
    keys = list(keys)
    spans = df.groupBy(*keys, "start").agg(F.max("end").alias("_e"))
    same = F.col("start") <= F.col("_reach") + max_gap if (touching or max_gap) else F.col("start") < F.col("_reach")
    slabs = Slabs(spans, keys, ["start"]).scan(("_reach", "max", F.col("_e"), False))
    slabs.scan(("island", "sum", F.when(same, 0).otherwise(1).cast("long"), True))
    return df.join(slabs.result().select(*keys, "start", "island"), keys + ["start"])


def loci_with_gaps(df: DataFrame, keys=("contig",)) -> DataFrame:
    """Merged loci with the distance to the previous one and a running number."""
    keys = list(keys)
    merged = merge_intervals(df, keys, touching=True)
    slabs = Slabs(merged, keys, ["start"]).scan(
        ("_prev", "max", F.col("end"), False), ("locus_no", "sum", F.lit(1).cast("long"), True))
    return slabs.result().withColumn("gap", F.col("start") - F.col("_prev")).drop("_prev")


def covered_length(df: DataFrame, keys=("contig",), along: dict | None = None) -> DataFrame:
    """Bases covered by at least one interval per key: what each adds behind the ends of earlier starts.

    ``along`` names columns that come with each key and their aggregate (``F.min`` or ``F.max``).
    """
    keys, along = list(keys), along or {}
    carried = [f(c).alias(c) for c, f in along.items()]
    spans = df.groupBy(*keys, "start").agg(F.max("end").alias("end"), *carried)
    seen = Slabs(spans, keys, ["start"]).scan(("_reach", "max", F.col("end"), False)).result()
    # greatest passes over nulls
    added = F.greatest(F.col("end") - F.greatest("_reach", F.col("start") - 1), F.lit(0))
    return seen.groupBy(*keys).agg(F.sum(added).alias("covered"), *carried)


def shared_length(a: DataFrame, b: DataFrame, keys=("contig",)) -> DataFrame:
    """Overlap of two sets = |A| + |B| - |A u B|; no join needed."""
    keys = list(keys)
    cols = keys + ["start", "end"]
    parts = [("a", a.select(cols)), ("b", b.select(cols)), ("u", a.select(cols).unionByName(b.select(cols)))]
    out = None
    for tag, df in parts:
        one = covered_length(df, keys).withColumn("side", F.lit(tag))
        out = one if out is None else out.unionByName(one)
    total = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("covered"))), F.lit(0))
    return out.groupBy(*keys).agg((total("a") + total("b") - total("u")).alias("shared"))


def closest_join(a: DataFrame, b: DataFrame, keys=("contig",)) -> DataFrame:
    """The overlapping ``b`` rows, or else every ``b`` row at the least distance."""
    keys = list(keys)
    near = closest_spans(a, b, keys)
    return a.join(near, keys + ["start", "end"]).select(*a.columns, *near.columns[len(keys) + 2:])


def closest_spans(a: DataFrame, b: DataFrame, keys=("contig",)) -> DataFrame:
    """Distinct spans of ``a`` with their J4 partners, as ``b_*``, and the distance.

    One scan finds the neighbours on both sides. The furthest end of any ``b`` that starts at or before
    a span's end tells whether one overlaps it, and else is its nearest end on the left; the next start is
    the nearest on the right. A place of a single ``b`` row brings that row along. Only spans that overlap
    some ``b``, or lie next to a place that several rows share, are joined with ``b``.
    """
    keys = list(keys)
    cols = [*keys, "start", "end"]
    rest = [c for c in b.columns if c not in keys]
    rows = b.dropna(subset=[*keys, "start"]).withColumn("_row", F.struct(*[F.col(c).alias(f"b_{c}") for c in rest]))
    shared = [F.count("_row").alias("_n"), F.min("_row").alias("_row")]
    # all rows of an end lie left of a span that no b overlaps if the first of them starts there
    ends = (rows.groupBy(*keys, F.col("end").alias("_at")).agg(F.min("start").alias("_pos"), *shared)
            .where("_at is not null").select(*keys, "_pos", F.struct("_at", "_n", "_row").alias("_ended")))
    marks = (rows.select(*keys, F.col("start").alias("_pos"), "_row").unionByName(ends, allowMissingColumns=True)
             .groupBy(*keys, "_pos").agg(F.max("_ended").alias("_ended"), *shared)
             .select(*keys, F.col("_pos").alias("end"), "_ended", F.struct(F.col("_pos").alias("_at"), "_n", "_row").alias("_started")))
    # marks have no start, so they precede the spans that end at their position
    asks = a.select(*cols).dropna()
    near = materialize(Slabs(asks.unionByName(marks, allowMissingColumns=True), keys, ["end", "start"], distinct=True)
                       .scan(("_left", "max", F.col("_ended"), True), ("_right", "next", F.col("_started"), False))
                       .where("start is not null").result().select(*cols, "_left", "_right"), "near")
    hits = overlap_join(near.where("_left._at >= start").select(*cols), b, keys).withColumn("distance", F.lit(0).cast("long"))
    dl, dr = F.col("start") - F.col("_left._at"), F.col("_right._at") - F.col("end")
    sides = F.array(*[F.when(d == F.col("distance"), F.struct(F.lit(c).alias("_side"), f"{c}._at", f"{c}._n", f"{c}._row"))
                      for d, c in ((dl, "_left"), (dr, "_right"))])
    lonely = (near.where("_left is null or _left._at < start").withColumn("distance", F.least(dl, dr).cast("long"))
              .select(*cols, "distance", F.explode(sides).alias("_p")))
    out = [*cols, *[f"b_{c}" for c in rest], "distance"]
    alone = lonely.where("_p._n = 1").select(*cols, "distance", "_p._row.*").select(out)
    places = rows.select(*keys, "_row", F.explode(F.array(
        F.struct(F.lit("_left").alias("_side"), F.col("end").alias("_at")),
        F.struct(F.lit("_right").alias("_side"), F.col("start").alias("_at")))).alias("_p")).select(*keys, "_p.*", "_row")
    several = lonely.where("_p._n > 1").select(*cols, "distance", "_p._side", "_p._at")
    several = several.join(places, keys + ["_side", "_at"]).select(*cols, "distance", "_row.*").select(out)
    return hits.select(out).unionByName(alone).unionByName(several)


def best_overlap_join(new: DataFrame, old: DataFrame, keys=("contig",),
                      name: str = "name") -> DataFrame:
    """For each new row the overlapping old row with the closest ends (ties: least id).

    Copies of a span are folded before the join, so only distinct spans meet.
    """
    keys = list(keys)
    spans = new.select(*keys, "start", "end").distinct()
    olds = old.groupBy(*keys, "start", "end").agg(F.min(name).alias(name))
    d = F.abs(F.col("start") - F.col("b_start")) + F.abs(F.col("end") - F.col("b_end"))
    best = (overlap_join(spans, olds, keys)
            .groupBy(*keys, "start", "end").agg(F.min(F.struct(d.alias("d"), F.col(f"b_{name}").alias("id"),
                                                               F.col("b_start").alias("s"), F.col("b_end").alias("e"))).alias("m"))
            .select(*keys, "start", "end", F.col("m.id").alias(f"old_{name}"), F.col("m.d").alias("shift"),
                    F.col("m.s").alias("old_start"), F.col("m.e").alias("old_end")))
    return new.join(best, keys + ["start", "end"])


def drop_contained(models: DataFrame, keys=("contig", "strand"), score: str = "score", name: str = "name") -> DataFrame:
    """Drop models inside another of the same strand; equal spans keep the best score.

    A span survives exactly when it is the longest of its start and no earlier start
    reaches its end, so one running maximum replaces the self-join. Scores are looked
    at only for the spans that are left.
    """
    keys = list(keys)
    longest = models.groupBy(*keys, "start").agg(F.max("end").alias("end"))
    scanned = Slabs(longest, keys, ["start"]).scan(("_reach", "max", F.col("end"), False)).result()
    keep = scanned.where("_reach is null or _reach < `end`").select(*keys, "start", "end")
    spans = keys + ["start", "end"]
    rest = [c for c in models.columns if c not in spans]
    best = (models.join(keep, spans, "left_semi").groupBy(*spans)
            .agg(F.max_by(F.struct(*rest), F.struct(score, name)).alias("_m")))
    return best.select(*[F.col(c) if c in spans else F.col(f"_m.{c}").alias(c) for c in models.columns])


def assign_clusters(genes: DataFrame, clusters: DataFrame, keys=("contig",),
                    name: str = "name") -> DataFrame:
    """Each gene's first overlapping cluster."""
    keys = list(keys)
    spans = genes.select(*keys, "start", "end").distinct()
    first = (overlap_join(spans, clusters.select(*keys, "start", "end", name), keys)
             .groupBy(*keys, "start", "end")
             .agg(F.min(F.struct("b_start", "b_end", f"b_{name}")).alias("m"))
             .select(*keys, "start", "end", F.col(f"m.b_{name}").alias("cluster")))
    return genes.join(first, keys + ["start", "end"])


def introns(exons: DataFrame, tx: str = "tx_id") -> DataFrame:
    """W4 on array-valued transcripts: gaps between consecutive exons."""
    pair = F.zip_with(F.slice("exons", 1, F.size("exons") - 1), F.slice("exons", 2, F.size("exons") - 1),
                      lambda l, r: F.struct((l["end"] + 1).alias("start"), (r["start"] - 1).alias("end")))
    keep = [c for c in exons.columns if c != "exons"]
    return (exons.where(F.size("exons") > 1).select(*keep, F.posexplode_outer(pair).alias("intron_no", "i"))
            .select(*keep, (F.col("intron_no") + 1).alias("intron_no"),
                    F.col("i.start").alias("start"), F.col("i.end").alias("end")))


def partition_spans(loci: DataFrame, lengths: DataFrame, per_part: int = 35, min_gap: int = 1500,
                    min_span: int = 10_000, keys=("contig",)) -> DataFrame:
    """Parts of about ``per_part`` merged loci that are cut only inside wide gaps.

    The target of cut ``i`` is locus ``i * n/chunks``; the cut goes to the last wide
    gap at or before it, or else to the first one after it. Contigs with few loci or
    without a wide gap stay whole; parts shorter than ``min_span`` are skipped.
    ``lengths`` holds one row per contig: keys and ``length``.
    """
    keys = list(keys)
    merged = merge_intervals(loci, keys, touching=True)
    slabs = Slabs(merged, keys, ["start"]).scan(
        ("_prev", "max", F.col("end"), False), ("_idx", "sum", F.lit(1).cast("long"), False))
    wide = (F.col("start") - F.col("_prev")) >= min_gap
    slabs.scan(("_back", "max", F.when(wide, F.struct("start", "_prev")), True))
    scanned = slabs.result()
    totals = scanned.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max("_back").isNotNull().alias("_any"))
    totals = (totals.withColumn("_chunks", F.when((F.col("_n") > per_part) & F.col("_any"),
                                                  F.ceil(F.col("_n") / per_part)).otherwise(1).cast("long"))
              .withColumn("_step", F.bround(F.col("_n") / F.col("_chunks")).cast("long"))
              .join(lengths.select(*keys, "length"), keys))
    ahead = (Slabs(scanned, keys, [F.col("start").desc()])
             .scan(("_fwd", "max", F.when(wide, F.struct((-F.col("start")).alias("s"), F.col("_prev"))), True)).result())
    cuts = (ahead.join(totals, keys).where("_idx > 0 and _idx % _step = 0 and _idx div _step < _chunks")
            .select(*keys, (F.expr("_idx div _step")).alias("part"),
                    F.coalesce(F.col("_back.start"), -F.col("_fwd.s")).alias("_cut"),
                    F.coalesce(F.col("_back._prev"), F.col("_fwd._prev")).alias("_before")))
    parts = totals.withColumn("part", F.explode_outer(F.sequence(F.lit(1).cast("long"), F.col("_chunks"))))
    opened = cuts.select(*keys, (F.col("part") + 1).alias("part"), (F.col("_before") + 1).alias("_from"))
    spans = (parts.join(cuts, keys + ["part"], "left").join(opened, keys + ["part"], "left")
             .withColumn("start", F.when(F.col("part") == 1, F.lit(1).cast("long")).otherwise(F.col("_from")))
             .withColumn("end", F.when((F.col("part") == F.col("_chunks")) | F.col("_cut").isNull(), F.col("length"))
                         .otherwise(F.col("_cut") - 1)))
    keep = (F.col("_chunks") == 1) | (F.col("end") - F.col("start") >= min_span)
    return spans.where(keep & F.col("start").isNotNull()).select(*keys, "part", "start", "end", "_n").withColumnRenamed("_n", "n_loci")


def slice_partition(features: DataFrame, parts: DataFrame, keys=("contig",)) -> DataFrame:
    """Features lying fully inside a part, with coordinates starting at 1 there."""
    inside = (F.col("start") >= F.col("b_start")) & (F.col("end") <= F.col("b_end"))
    joined = overlap_join(features, parts.select(*keys, "start", "end", "part"), keys, inside)
    return (joined.withColumn("start", F.col("start") - F.col("b_start") + 1)
            .withColumn("end", F.col("end") - F.col("b_start") + 1)
            .withColumnRenamed("b_part", "part").drop("b_start", "b_end"))


def chunk_spans(lengths: DataFrame, size: int = 500_000, overlap: int = 10_000) -> DataFrame:
    """Equal chunks of contigs longer than ``size``, each reaching ``overlap`` into the next."""
    n = F.when(F.col("length") > size, F.floor(F.col("length") / size) + 1).otherwise(1).cast("long")
    out = lengths.withColumn("_n", n).withColumn("_step", F.floor(F.col("length") / F.col("_n")))
    out = out.withColumn("chunk", F.explode_outer(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    start = F.greatest((F.col("chunk") - 1) * F.col("_step"), F.lit(1).cast("long"))
    end = F.when(F.col("chunk") == F.col("_n"), F.col("length")).otherwise(
        F.least(F.col("chunk") * F.col("_step") + overlap, F.col("length")))
    return out.withColumn("start", start).withColumn("end", end).drop("_n", "_step")


def renumber_clusters(df: DataFrame, keys=("contig",), number: str = "n") -> DataFrame:
    """Members with consecutive numbers form one cluster, numbered in order."""
    keys = list(keys)
    slabs = Slabs(df, keys, [number]).scan(("_prev", "max", F.col(number), False))
    slabs.scan(("cluster", "sum", F.when(F.col(number) - F.col("_prev") > 1, 1)
                .otherwise(F.when(F.col("_prev").isNull(), 1).otherwise(0)).cast("long"), True))
    return slabs.result().drop("_prev")


def collapse_spans(df: DataFrame, keys: list[str]) -> DataFrame:
    """One span per group of rows."""
    return df.groupBy(*keys).agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                 F.count(F.lit(1)).alias("n_rows"))


def pad_spans(df: DataFrame, flank: int, length: str | None = None) -> DataFrame:
    end = F.col("end") + flank
    return (df.withColumn("start", F.greatest(F.col("start") - flank, F.lit(1)))
            .withColumn("end", F.least(end, F.col(length)) if length else end))
