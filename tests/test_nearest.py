"""Closest join: both neighbours come out of one scan."""

import glob
import random

from pyspark.sql import functions as F

from exonloom import scale
from exonloom.operators import intervals as I
from exonloom.scale import Slabs

SCHEMA = "contig string, start long, end long, name string"


def spans(seed, n, contigs, reach, span):
    rnd = random.Random(seed)
    starts = [(rnd.choice(contigs), rnd.randrange(reach)) for _ in range(n)]
    return [(c, s, s + rnd.randrange(span), f"{seed}.{i}") for i, (c, s) in enumerate(starts)]


def nearest(ra, rb):
    want = []
    for x in ra:
        dist = [(0 if x[1] <= y[2] and x[2] >= y[1] else max(y[1] - x[2], x[1] - y[2]), y) for y in rb if y[0] == x[0]]
        want += [(x[3], y[3], y[1], y[2], d) for d, y in dist if d == min(dist)[0]]
    return sorted(want)


def in_slabs(spark, path):
    """Several slabs, which adaptive execution would make one of."""
    if path == "large":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")


def test_places_that_several_rows_share(spark, path):
    in_slabs(spark, path)
    try:
        ra = spans(1, 150, ["c", "d", "e"], 400, 4)
        # few places: equal starts, equal ends, copies, ties on both sides, and a contig without any
        rb = [(c, s - s % 20, e - e % 20 + 20, n) for c, s, e, n in spans(2, 40, ["c", "d"], 400, 30)]
        rb += [(c, s, e, n + "'") for c, s, e, n in rb[:8]]
        ra += [(c, s, e, n + "'") for c, s, e, n in ra[:8]]
        a, b = spark.createDataFrame(ra + [("c", None, 7, "no start"), (None, 1, 7, "no contig")], SCHEMA), spark.createDataFrame(rb, SCHEMA)
        want = nearest(ra, rb)
        got = I.closest_join(a, b)
        assert got.columns == ["contig", "start", "end", "name", "b_start", "b_end", "b_name", "distance"]
        assert sorted(map(tuple, got.select("name", "b_name", "b_start", "b_end", "distance").collect())) == want
        copies = {r[:3]: r[3] for r in ra}
        one = I.closest_spans(a, b)
        assert sorted((copies[tuple(r[:3])], r["b_name"], r["distance"]) for r in one.collect()) == sorted(
            (n, m, d) for n, m, _, _, d in want if n in copies.values())
        assert I.closest_spans(a, b.limit(0)).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_next_value_reaches_over_slabs(spark, path):
    in_slabs(spark, path)
    try:
        rows = spark.range(2000).select((F.col("id") % 3).alias("k"), "id", F.when(F.col("id") % 700 < 3, F.col("id")).alias("v"))
        line = Slabs(rows, ["k"], ["id"])
        assert line.single == (path == "small")
        got = line.scan(("n", "next", F.col("v"), False), ("at", "next", F.col("v"), True), ("l", "last", F.col("v"), True)).result().collect()
        assert len(got) == 2000
        marks = [i for i in range(2000) if i % 700 < 3]
        for r in got:
            own = [i for i in marks if i % 3 == r["k"]]
            assert r["n"] == min((i for i in own if i > r["id"]), default=None)
            assert r["at"] == min((i for i in own if i >= r["id"]), default=None)
            assert r["l"] == max((i for i in own if i <= r["id"]), default=None)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_spans_are_written_twice_at_most(spark, tmp_path, monkeypatch):
    """A span is written for the scan and with its neighbours, a mark once."""
    monkeypatch.setattr(scale, "work_dir", lambda spark: str(tmp_path))
    a, b = (spark.createDataFrame(spans(s, n, ["c", "d"], 10**6, 5), SCHEMA) for s, n in ((3, 500), (4, 50)))
    assert I.closest_join(a, b).count() >= 500
    assert 500 < sum(spark.read.parquet(f).count() for f in glob.glob(f"{tmp_path}/exonloom-*")) <= 2 * 500 + 50
