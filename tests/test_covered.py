"""Covered length per key in one pass, with what comes along, against sets of bases."""

import numpy as np
from pyspark.sql import functions as F

from exonloom.operators import hits as H
from exonloom.operators import intervals as I


def test_covered_length_carries_columns(spark, path):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        s = int(rng.integers(1, 60))
        rows.append((f"k{int(rng.integers(0, 40)) ** 2 // 40}", s, s + int(rng.integers(0, 25)), int(rng.integers(0, 1000)), float(i % 17)))
    df = spark.createDataFrame(rows, "contig string, start long, `end` long, low long, score double")
    made = I.covered_length(df, ["contig"], {"low": F.min, "score": F.max})
    got = {r["contig"]: (r["covered"], r["low"], r["score"]) for r in made.collect()}
    of = lambda k: [r for r in rows if r[0] == k]
    assert got == {k: (len({p for r in of(k) for p in range(r[1], r[2] + 1)}), min(r[3] for r in of(k)), max(r[4] for r in of(k))) for k in {r[0] for r in rows}}


def test_small_keys_are_shuffled_once_after_the_scan(spark):
    df = spark.range(1000).selectExpr("concat('k', id % 300) as contig", "id as start", "id + 5 as `end`")
    plan = I.covered_length(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_busco_is_measured_without_a_join_of_its_own_rows(spark, path):
    hits = spark.createDataFrame([("B1", "g1", 1, 10, 30.0), ("B1", "g1", 8, 30, 50.0), ("B1", "g1", 40, 41, 9.0), ("B2", "g1", 1, 5, 80.0)], "busco string, gene string, hmm_start long, hmm_end long, score double")
    cut = spark.createDataFrame([("B1", 20.0, 32.0, 2.0), ("B2", 20.0, 40.0, 2.0)], "busco string, min_score double, mean_len double, sigma_len double")
    made = H.measure_busco(hits, cut)
    assert made._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 0
    assert {(r["busco"], r["covered"], r["score"], r["sigma"], r["class"]) for r in made.collect()} == {("B1", 30, 50.0, 1.0, "complete"), ("B2", 5, 80.0, 17.5, "fragment")}
