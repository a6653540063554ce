"""Distances by blocks of species and supermatrices in pieces, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from exonloom.operators import comparative as C
from exonloom.sinks import text as K


@pytest.mark.parametrize("block, most", [(256, 1 << 20), (4, 40), (1, 1 << 20)])
def test_distances_by_blocks(spark, block, most):
    """A family in every species, one in one, species that share nothing, counts of zero."""
    rng = np.random.default_rng(8)
    rows = [(f"s{i}", f"f{f}", int(rng.integers(0, 9))) for i in range(23) for f in rng.choice(30, 7, replace=False)]
    rows += [(f"s{i}", "everywhere", i + 1) for i in range(23)] + [("alone", "own", 4), ("alone2", "own2", 1)]
    got = {(r.sp_a, r.sp_b): r.distance for r in C.braycurtis(spark.createDataFrame(rows, "species string, family string, n long"), block, most).collect()}
    names, table = sorted({s for s, _, _ in rows}), {(s, f): n for s, f, n in rows}
    families = {f for _, f, _ in rows}
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            x, y = (np.array([table.get((s, f), 0) for f in sorted(families)]) for s in (a, b))
            assert got.pop((a, b)) == pytest.approx(abs(x - y).sum() / (x + y).sum(), abs=1e-12)
    assert not got


def test_distances_of_nothing(spark):
    none = spark.createDataFrame([], "species string, family string, n long")
    assert C.braycurtis(none).count() == 0
    assert C.braycurtis(spark.createDataFrame([("a", "f", 2)], none.schema)).count() == 0


@pytest.mark.parametrize("small", ["1000000", "10"])
def test_supermatrix_in_pieces(spark, tmp_path, small):
    rng = np.random.default_rng(4)
    groups = [(s, f"g{g:03}", f"{s}{g}") for s in "abc" for g in range(60)]
    seqs = {x: "".join(rng.choice(list("MKVLA"), int(rng.choice([0, 1, 30, 900])))) for _, _, x in groups}
    g = spark.createDataFrame(groups, "species string, group_id string, gene_id string")
    p = spark.createDataFrame([(s, x, seqs[x]) for s, _, x in groups], "species string, gene_id string, seq string")
    whole = {r.species: r.seq for r in C.supermatrix(g, p).collect()}
    spark.conf.set("spark.exonloom.smallRows", small)
    try:
        pieces = C.supermatrix_pieces(g, p, 128)
        got = {}
        for r in pieces.collect():
            assert r.offset == 128 * r.piece and len(r.chunk) <= 128
            got.setdefault(r.seq_id, {})[r.piece] = r.chunk
        assert {s: "".join(c[k] for k in sorted(c)) for s, c in got.items()} == whole
        assert all(len(c[k]) == 128 for c in got.values() for k in range(len(c) - 1))
        K.write_fasta_blocks(pieces, str(tmp_path / f"m{small}"), 60)
    finally:
        spark.conf.unset("spark.exonloom.smallRows")
    lines = [r.value for r in spark.read.text(str(tmp_path / f"m{small}")).withColumn("i", F.monotonically_increasing_id()).orderBy("i").collect()]
    assert "".join(x for x in lines if not x.startswith(">")) == "".join(whole[s] for s in "abc")
