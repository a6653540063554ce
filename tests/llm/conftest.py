import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(__file__))
from brute import prose  # noqa: E402

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents table from (doc_id, text, source) rows; also carries columns with clashing names."""

    def make(rows, clash=False):
        df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOC_SCHEMA)
        if clash:
            for c in ("row", "size", "key", "node", "bucket", "length", "offset", "kept", "score", "k1", "batch", "shard", "copies"):
                df = df.selectExpr("*", f"cast(doc_id as string) as `{c}`")
        return df.repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    import numpy as np

    rng = np.random.default_rng(5)
    base = prose(rng, 120)
    rows = [(1, base, "a"), (2, base, "a"), (3, None, None), (4, "", "b"), (5, " \t\n", "b"), (6, "one", "c"), (None, prose(rng, 50), "c"), (7, prose(rng, 30000), "d"),
            (8, "x" * 200000, "d"), (9, base + " tail", None), (9, base + " tail", None), (9, base + " tail", None), (10, "é ñ 漢字 😀 " * 30, "a"), (11, prose(rng, 60) + " " + base, "b")]
    return rows + [(20 + i, prose(rng, int(rng.integers(1, 300))), "abcd"[i % 4]) for i in range(40)]
