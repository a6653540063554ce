"""Interval operators against plain loops, on both evaluation paths."""

import random

from pyspark.sql import functions as F

from exonloom.operators import graph as G
from exonloom.operators import hits as H
from exonloom.operators import intervals as I
from exonloom.operators.diff import lcs_length
from exonloom.scale import number_rows


def make(spark, seed, n, long_share=0.0, span=2000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one contig holds most rows, as a hot chromosome would
        c = "chr1" if rnd.random() < 0.7 else rnd.choice(["chr2", "chr10"])
        s = rnd.randrange(1, span)
        length = rnd.randrange(0, 40) if rnd.random() >= long_share else rnd.randrange(5000, 60000)
        rows.append((c, s, s + length, f"n{seed}_{i}", rnd.choice("+-"), float(rnd.randrange(50))))
    return rows, spark.createDataFrame(rows, "contig string, start long, end long, name string, strand string, score double")


def test_overlap_join_with_long_intervals(spark, path):
    ra, a = make(spark, 1, 300, 0.03)
    rb, b = make(spark, 2, 250, 0.03)
    want = sorted((x[3], y[3]) for x in ra for y in rb if x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1])
    got = I.overlap_join(a, b).select("name", "b_name").collect()
    assert sorted(map(tuple, got)) == want


def test_crowded_bins_are_split(spark):
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        ra, a = make(spark, 3, 400, span=120)
        rb, b = make(spark, 4, 60, span=120)
        want = sorted((x[3], y[3]) for x in ra for y in rb if x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1])
        assert sorted(map(tuple, I.overlap_join(a, b).select("name", "b_name").collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_exists_and_fraction(spark, path):
    ra, a = make(spark, 5, 300)
    rb, b = make(spark, 6, 60)
    hit = lambda x, y: x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1]
    yes = sorted(x[3] for x in ra if any(hit(x, y) for y in rb))
    assert sorted(r[0] for r in I.overlap_semi(a, b).select("name").collect()) == yes
    assert sorted(r[0] for r in I.overlap_anti(a, b).select("name").collect()) == sorted(set(x[3] for x in ra) - set(yes))
    frac = sorted(x[3] for x in ra if any(hit(x, y) and min(x[2], y[2]) - max(x[1], y[1]) + 1 >= 0.9 * (x[2] - x[1] + 1) for y in rb))
    assert sorted(r[0] for r in I.overlap_fraction(a, b).select("name").collect()) == frac


def test_closest(spark, path):
    ra, a = make(spark, 7, 120)
    rb, b = make(spark, 8, 40)
    want = set()
    for x in ra:
        dist = [(0 if x[1] <= y[2] and x[2] >= y[1] else max(y[1] - x[2], x[1] - y[2]), y[3]) for y in rb if y[0] == x[0]]
        if dist:
            d = min(dist)[0]
            want |= {(x[3], n, d) for e, n in dist if e == d}
    got = {tuple(r) for r in I.closest_join(a, b).select("name", "b_name", "distance").collect()}
    assert got == want


def test_merge_and_contained(spark, path):
    rows, df = make(spark, 9, 200)
    want = []
    for c in sorted({r[0] for r in rows}):
        cur = None
        for s, e in sorted((r[1], r[2]) for r in rows if r[0] == c):
            if cur and s < cur[1]:
                cur[1] = max(cur[1], e)
            else:
                cur = [s, e]
                want.append((c, cur))
    assert sorted(map(tuple, I.merge_intervals(df).select("contig", "start", "end").collect())) == sorted((c, s, e) for c, (s, e) in want)
    keep = set()
    for x in rows:
        same = [y for y in rows if y[0] == x[0] and y[4] == x[4]]
        inside = any(y[1] <= x[1] and y[2] >= x[2] and (y[1], y[2]) != (x[1], x[2]) for y in same)
        best = max((y for y in same if (y[1], y[2]) == (x[1], x[2])), key=lambda y: (y[5], y[3]))
        if not inside and best[3] == x[3]:
            keep.add(x[3])
    assert {r[0] for r in I.drop_contained(df).select("name").collect()} == keep


def test_numbering(spark, path):
    rows, df = make(spark, 10, 300)
    got = {r["name"]: r["rn"] for r in number_rows(df, ["start", "name"], "rn", ["contig"]).collect()}
    for c in {r[0] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[0] == c), key=lambda r: (r[1], r[3])), 1):
            assert got[r[3]] == i
    got = sorted(r["rn"] for r in number_rows(df, ["contig", "start", "name"]).collect())
    assert got == list(range(1, 301))


def test_documented_interval_rules(spark):
    mk = lambda rows: spark.createDataFrame([("c", s, e) for s, e in rows], "contig string, start long, end long")
    spans = lambda df: sorted((r["start"], r["end"]) for r in df.collect())
    assert spans(I.merge_intervals(mk([(2, 4), (4, 9)]))) == [(2, 4), (4, 9)]
    assert spans(I.merge_intervals(mk([(2, 6), (4, 10)]))) == [(2, 10)]
    assert spans(I.merge_intervals(mk([(2, 20), (20, 22), (30, 40), (10, 31)]))) == [(2, 40)]
    assert spans(I.overlap_semi(mk([(2, 2), (3, 3), (4, 4)]), mk([(2, 3)]))) == [(2, 2), (3, 3)]
    near = I.closest_join(mk([(11, 12)]), mk([(2, 3), (20, 22)]).withColumn("name", F.lit("x")))
    assert sorted((r["b_start"], r["distance"]) for r in near.collect()) == [(2, 8), (20, 8)]


def test_components(spark):
    rnd = random.Random(11)
    edges = [(f"v{rnd.randrange(120):03d}", f"v{rnd.randrange(120):03d}") for _ in range(90)] + [("v000", f"w{i:03d}") for i in range(60)]
    parent = {}
    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in G.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == {x: find(x) for x in parent}


def test_contained_contigs(spark, path):
    rnd = random.Random(12)
    base = "".join(rnd.choice("ACGT") for _ in range(600))
    seqs = [("long", base), ("copy", base), ("part", base[100:400]), ("edit", base[50:300] + "ACGTTGCA" * 20), ("other", "".join(rnd.choice("ACGT") for _ in range(250)))]
    seqs += [(f"fam{i}", base[: 500 - i]) for i in range(12)]
    k, cov = 21, 0.95
    grams = {n: {s[i:i + k] for i in range(len(s) - k + 1)} for n, s in seqs}
    uniq = {}
    for n, s in sorted(seqs):
        uniq.setdefault(s, n)
    left = {n: s for s, n in uniq.items()}
    keep = set()
    for n, s in left.items():
        bigger = [m for m, q in left.items() if m != n and (len(q) > len(s) or (len(q) == len(s) and m < n))]
        if not any(len(grams[n] & grams[m]) >= cov * len(grams[n]) for m in bigger):
            keep.add(n)
    got = {r[0] for r in H.dedup_contained(spark.createDataFrame(seqs, "seq_id string, seq string"), k, cov).select("seq_id").collect()}
    assert got == keep


def test_lcs():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]
    rnd = random.Random(13)
    for _ in range(50):
        a = "".join(rnd.choice("ABCD") for _ in range(rnd.randrange(0, 30)))
        b = "".join(rnd.choice("ABCD") for _ in range(rnd.randrange(0, 30)))
        assert lcs_length(a, b) == slow(a, b)


def test_closure_meets_each_pair_once(spark, monkeypatch):
    """A ring, a chord, a chain of 70 and two parents: all pairs are right, and no table holds a pair of an earlier one."""
    edges = [(i, i + 1) for i in range(9)] + [(9, 0), (0, 5), (3, 3)] + [(100 + i, 101 + i) for i in range(70)] + [(200, 201), (200, 202), (201, 203), (202, 203)]
    want = set(edges)
    while True:
        more = want | {(a, d) for a, b in want for c, d in edges if b == c}
        if more == want:
            break
        want = more
    written = []
    true = G.materialize
    monkeypatch.setattr(G, "materialize", lambda df, name="t": written.append(true(df, name)) or written[-1])
    got = [tuple(r) for r in G.go_closure(spark.createDataFrame(edges, "node long, ancestor long")).collect()]
    assert len(got) == len(want) and set(got) == want
    assert sum(df.count() for df in written) == len(want)


def test_components_count_on_numbers(spark, monkeypatch):
    """Text labels, loops, a lone loop and a missing end: the least text is the label, and the rounds see numbers only."""
    kinds = []
    true = G._star
    monkeypatch.setattr(G, "_star", lambda edges, large: kinds.append(edges.schema["u"].dataType.simpleString()) or true(edges, large))
    edges = [("b", "a10"), ("a10", "a9"), ("z", "é"), ("é", "y"), ("q", "q"), ("b", "b"), ("m", None)] + [(f"n{i}", f"n{i + 1}") for i in range(30)]
    got = {r["node"]: r["component"] for r in G.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    want = {"b": "a10", "a10": "a10", "a9": "a10", "z": "y", "é": "y", "y": "y", "q": "q", "m": "m", None: None} | {f"n{i}": "n0" for i in range(31)}
    assert got == want
    assert set(kinds) == {"bigint"}
