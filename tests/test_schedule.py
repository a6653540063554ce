"""Weighted interval scheduling and consensus models against brute force."""

import hashlib

import numpy as np
import pytest

from exonloom.operators import models as M
from exonloom.operators.schedule import schedule

COLS = "contig string, strand string, start long, `end` long, score long, name string"


def number(name):
    return int(hashlib.md5(name.encode()).hexdigest()[:8], 16)


def by_hand(rows):
    """Best choice by trying every subset, span by span, keyed by where the last one ends."""
    best = {0: ((0, 0), ())}
    for s, e, score, name in sorted(rows, key=lambda r: (r[1], r[0])):
        old = max((v for k, v in best.items() if k < s), key=lambda v: v[0])
        new = ((old[0][0] + score, old[0][1] + number(name)), old[1] + ((s, e, score, name),))
        if e not in best or new[0] > best[e][0]:
            best[e] = new
    return set(max(best.values(), key=lambda v: v[0])[1])


@pytest.mark.parametrize("most", [5, 17, 20_000])
def test_schedule_matches_brute_force(spark, path, most):
    rng = np.random.default_rng(most)
    rows = []
    for k in range(12):
        wide = [8, 40, 400][k % 3]
        for i in range(int(rng.integers(1, 70))):
            s = int(rng.integers(1, 300))
            rows.append((f"c{k // 2}", "+-"[k % 2], s, s + int(rng.integers(0, wide)), int(rng.integers(0, 6)), f"m{k}.{i}"))
    rows += [("hot", "+", i, i + 3 + 60 * (i % 40 == 0), 1 + i % 5, f"h{i}") for i in range(1, 400)]
    rows += rows[:5] + [(None, "+", 3, 4, 1, "null"), ("neg", "-", 1, 5, 0, "zero")]
    got = {}
    for r in schedule(spark.createDataFrame(rows, COLS), most=most).collect():
        got.setdefault((r["contig"], r["strand"]), []).append((r["start"], r["end"], r["score"], r["name"]))
    places = {(c, t) for c, t, *_ in rows if c != "neg"}
    for c, t in places:
        if c is None:
            continue
        own = got[c, t]
        assert len(own) == len(set(own)) and set(own) == by_hand({r[2:] for r in rows if r[:2] == (c, t) and r[4] > 0}), (c, t)
    assert ("neg", "-") not in got


def test_schedule_of_nothing(spark):
    assert schedule(spark.createDataFrame([], COLS)).count() == 0


def test_bridging_model_gives_way(spark):
    cols = "name string, contig string, strand string, start long, `end` long, source string, chain string"
    rows = [(f"a{i}", "c", "+", 100, 200, s, "100-200") for i, s in enumerate(["snap", "augustus", "genemark"])]
    rows += [(f"b{i}", "c", "+", 300, 400, s, "300-400") for i, s in enumerate(["snap", "augustus", "genemark"])]
    rows += [("bridge", "c", "+", 100, 400, "glimmerhmm", "100-200,300-400"), ("other", "c", "-", 150, 350, "snap", "150-350"), ("loud", "d", "+", 1, 90, "pasa", "1-90"), ("quiet", "d", "+", 80, 120, "mine", "80-120")]
    none = spark.createDataFrame([], "contig string, start long, `end` long")
    got = lambda **k: sorted((r["name"], r["score"]) for r in M.consensus_models(spark.createDataFrame(rows, cols), none, **k).collect())
    assert got() == [("a0", 3), ("b0", 3), ("loud", 6), ("other", 1)]
    assert got(weights={"mine": 9}) == [("a0", 3), ("b0", 3), ("other", 1), ("quiet", 9)]
    assert got(weights={"glimmerhmm": 7})[0] == ("bridge", 7)


def test_many_small_keys_share_batches(spark):
    """300 keys of 1 to 9 spans in batches of 7 rows: no call per key, and the choice of each is the best."""
    rng = np.random.default_rng(5)
    rows = []
    for c in range(300):
        for i in range(int(rng.integers(1, 10))):
            s = int(rng.integers(1, 40))
            rows.append((f"c{c}", "+-"[c % 2], s, s + int(rng.integers(0, 12)), int(rng.integers(1, 9)), f"n{c}.{i}"))
    one = {}
    for r in rows:
        old = one.get(r[:4])
        if old is None or (r[4], number(r[5])) > (old[4], number(old[5])):
            one[r[:4]] = r
    want = []
    for key in sorted({r[:2] for r in rows}):
        want += [(*key, *x) for x in by_hand([r[2:] for r in one.values() if r[:2] == key])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        made = schedule(spark.createDataFrame(rows, COLS).repartition(3))
        got = [tuple(r) for r in made.select("contig", "strand", "start", "end", "score", "name").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got) == sorted(want)
    assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().toString()
