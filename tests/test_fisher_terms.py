"""p-values of large populations."""

import math

import numpy as np
from pyspark.sql import functions as F

from exonloom.operators import graph as G


def brute(k, n, kk, nn):
    i = np.arange(max(0, n + kk - nn), min(n, kk) + 1)
    f = lambda x: np.vectorize(math.lgamma)(np.asarray(x, dtype=float) + 1)
    logs = f(kk) + f(nn - kk) + f(n) + f(nn - n) - f(nn) - f(i) - f(kk - i) - f(n - i) - f(nn - kk - n + i)
    return min(1.0, math.fsum(np.exp(logs[logs <= logs[k - i[0]] + 1e-7])))


def test_terms_grow_slower_than_the_population(spark):
    cases = [(200_300, 3_000_000, 600_000, 9_000_000), (3, 40, 50, 9_000_000), (1990, 2000, 400_000, 401_000), (0, 5, 7, 30), (12, 300_000, 900_000, 9_000_000)]
    df = spark.createDataFrame(cases, "k long, n long, kk long, nn long")
    cols = [F.col(c) for c in ("k", "n", "kk", "nn")]
    rows = df.select(*cols, G.fisher_p(*cols).alias("p"), F.size(G.likely_counts(*cols[1:])).alias("terms")).collect()
    for r in rows:
        want = brute(r["k"], r["n"], r["kk"], r["nn"])
        assert abs(r["p"] - want) <= 1e-6 * max(want, 1e-300)
        assert r["terms"] <= 60 * math.sqrt(min(r["n"], r["kk"])) + 600
