"""Locus groups against all pairs, and their number of links."""

import random

import pytest

from exonloom.operators import graph as G


def groups(rows, frac):
    """Component of each distinct span, by comparing all pairs."""
    spans = sorted(set(rows))
    root = {x: x for x in spans}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(spans):
        for b in spans[:i]:
            shared = max(0, min(a[2], b[2]) - max(a[1], b[1]))
            if a[0] == b[0] and shared and shared >= frac * min(a[2] - a[1], b[2] - b[1]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    out = {}
    for x in spans:
        out.setdefault(top(x), set()).add(x)
    return sorted(map(sorted, out.values()))


def found(df, frac):
    out = {}
    for r in G.group_loci(df, frac).collect():
        out.setdefault(r["locus"], set()).add((r["contig"], r["start"], r["end"]))
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("frac", [0.3, 0.5, 0.8])
def test_groups_equal_all_pairs(spark, frac):
    rows = []
    for seed, room, longest in ((1, 300, 12), (2, 3000, 60), (3, 5000, 400)):
        rnd = random.Random(seed)
        for _ in range(150):
            s, n = rnd.randrange(room), rnd.randrange(longest)
            rows.append((f"{seed}{rnd.choice('aab')}", s, s + n))
    rows += rows[:10]
    df = spark.createDataFrame(rows, "contig string, start long, end long")
    assert found(df, frac) == groups(rows, frac)


def test_groups_by_slabs(spark):
    spark.conf.set("spark.exonloom.smallRows", "0")
    try:
        rows = [("c", 7 * k % 900, 7 * k % 900 + 3 + k % 40) for k in range(300)]
        assert found(spark.createDataFrame(rows, "contig string, start long, end long"), 0.3) == groups(rows, 0.3)
    finally:
        spark.conf.unset("spark.exonloom.smallRows")


def test_links_grow_with_spans_not_pairs(spark):
    rows = [("c", k, 100_000 + k) for k in range(4000)]
    named = spark.createDataFrame(rows, "contig string, start long, end long").selectExpr("*", "format_string('%019d', start) as span")
    links = G._run_links(G._core_runs(named, 0.3, ["contig"])).distinct()
    assert links.count() <= 3 * len(rows)
    assert G.components(links).select("component").distinct().count() == 1
