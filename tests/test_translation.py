"""Translation of whole batches against codon by codon."""

import numpy as np
import pyarrow as pa
import pytest

from exonloom.functions import sequence as S
from exonloom.functions.codes import codon_table


def by_hand(seq, offset, table):
    s = seq.upper()[offset:]
    return "".join(codon_table(table).get(s[i:i + 3], "X") for i in range(0, len(s) - 2, 3))


@pytest.mark.parametrize("most", [10, 100, 4_000_000])
def test_translation_of_batches(spark, monkeypatch, most):
    monkeypatch.setattr(S, "TRANSLATED", most)
    rng = np.random.default_rng(most)
    seqs = ["".join(rng.choice(list("ACGTacgtNU"), int(n))) for n in rng.integers(0, 50, 200)]
    seqs += ["", "A", "AC", "ATG", "ATGé", "éATG", "AT\U0001F600TGA", "ACG" * 5000]
    rows = [(i, s) for i, s in enumerate(seqs)] + [(len(seqs), None)]
    df = spark.createDataFrame(rows, "i int, seq string")
    made = df.select("i", S.translate(S.F.col("seq"), S.F.col("i") % 3).alias("a"), S.translate(S.F.col("seq"), 0, 12).alias("b"))
    got = {r["i"]: (r["a"], r["b"]) for r in made.collect()}
    assert got == {i: (None, None) if s is None else (by_hand(s, i % 3, 1), by_hand(s, 0, 12)) for i, s in rows}
    assert "ArrowEvalPython" in made._jdf.queryExecution().toString()
    # slices and blocks of a batch
    codes, amino = S._codes(1)
    part = pa.array(["zz", None, "ATGATGA", "", "ATGAAA", "ATG"]).slice(1)
    assert S._translated(part, codes, amino).to_pylist() == [None, "MM", "", "MK", "M"]


def test_six_frames_in_one_call(spark):
    rows = [(0, "ATGAAATAGC"), (1, ""), (2, None), (3, "acgtnnéACGTT")]
    made = spark.createDataFrame(rows, "i int, seq string").select("i", S.six_frames(S.F.col("seq")).alias("f"))
    rc = lambda s: "".join({"A": "T", "C": "G", "G": "C", "T": "A", "N": "N"}[x] for x in reversed(s.upper()) if x in "ACGTN")
    want = {i: [None] * 6 if s is None else [by_hand(s, k, 1) for k in (0, 1, 2)] + [by_hand(rc(s), k, 1) for k in (0, 2, 1)] for i, s in rows}
    assert {r["i"]: r["f"] for r in made.collect()} == want
    assert made._jdf.queryExecution().executedPlan().toString().count("regexp_replace") == 1
