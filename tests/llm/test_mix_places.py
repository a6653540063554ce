"""Only places go through the slabs: texts are never written there."""

import glob

from pyspark.sql import functions as F

from exonloom.llm import mixing
from exonloom.scale import work_dir


def test_texts_stay_out_of_the_slabs(spark):
    before = set(glob.glob(f"{work_dir(spark)}/exonloom-slabs-*"))
    rows = [(i // 2, None if i % 7 == 0 else "abc"[i % 3], "word " * (i % 5), 1) for i in range(120)] + [(None, "a", None, i) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, other int").withColumn("size", (F.coalesce(F.length("text"), F.lit(0)) / 5).cast("long"))
    out = mixing.copies(docs, text="text")
    got = out.toPandas()
    assert len(got) == len(rows) and sorted(out.columns) == sorted([*docs.columns, "source_size", "target", "copies"])
    for _, part in got.groupby("source", dropna=False):
        rate = part["target"].iloc[0] / part["source_size"].iloc[0]
        assert abs(part["copies"].sum() - rate * len(part)) < 1 and part["copies"].between(int(rate), int(rate) + 1).all()
    slabs = set(glob.glob(f"{work_dir(spark)}/exonloom-slabs-*")) - before
    assert slabs and all("text" not in spark.read.parquet(p).columns for p in slabs)
