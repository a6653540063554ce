"""Training models without pairs: the best of what overlaps, against brute force."""

import numpy as np
import pytest

from exonloom.operators import models as M


def by_hand(rows):
    better = lambda a, b: (-a[4], a[0]) < (-b[4], b[0])
    return sorted(r[0] for r in rows if r[1] is None or not any(q[1] == r[1] and q[2] <= r[3] and q[3] >= r[2] and better(q, r) and q[2:4] != r[2:4] or
                                                              q[1:4] == r[1:4] and better(q, r) for q in rows))


@pytest.mark.parametrize("wide", [3, 60, 900])
def test_beaten_models(spark, path, wide):
    rng = np.random.default_rng(wide)
    rows = []
    for i in range(500):
        s = int(rng.integers(1, 1000))
        rows.append((f"g{i:03}", f"c{i % 3}", s, s + int(rng.integers(0, wide)), int(rng.integers(1, 6))))
    rows += [("z1", "c0", 5, 5, 2), ("z2", "lonely", 1, 2, 1)]
    df = spark.createDataFrame(rows, "gene_id string, contig string, start long, `end` long, n_cds long")
    got = sorted(r["gene_id"] for r in M.select_training(df, df).collect())
    assert got == by_hand(rows)
    assert M.select_training(df.limit(0), df).count() == 0


def test_many_models_on_one_place(spark):
    """20 000 models that all overlap: one wins, and no pair table is built (400 million pairs)."""
    df = spark.range(20_000).selectExpr("concat('g', id) as gene_id", "'c' as contig", "1000 - id % 997 as start", "2000 + id as `end`", "id % 50 as n_cds")
    assert [r["gene_id"] for r in M.select_training(df, df).collect()] == [min(f"g{i}" for i in range(49, 20_000, 50))]


def test_sparse_models_are_compared_in_their_islands(spark, path, monkeypatch):
    """5000 models in islands of up to 200: none is ranked, and a crowded island is, with the same answer."""
    ranked = []
    true = M.beaten_spans
    monkeypatch.setattr(M, "beaten_spans", lambda spans: ranked.append(spans.count()) or true(spans))
    df = spark.range(5000).selectExpr("concat('g', id) as gene_id", "'c' as contig", "(id div 150) * 10000 + id % 150 as start", "(id div 150) * 10000 + id % 150 + 5 as `end`", "(id * 7) % 11 as n_cds")
    rows = [tuple(r) for r in df.collect()]
    near = {i: [r for r in rows if r[2] // 10000 == i] for i in range(34)}
    want = sorted(g for some in near.values() for g in by_hand(some))
    assert sorted(r["gene_id"] for r in M.select_training(df, df).collect()) == want
    assert not ranked
    spans = df.selectExpr("contig", "start", "`end`", "-n_cds as k", "gene_id")
    assert sorted(r["gene_id"] for r in M.best_of_islands(spans, few=100).collect()) == want
    assert ranked == [4950]
