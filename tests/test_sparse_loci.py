"""Locus groups and scans over many small keys."""

from pyspark.sql import functions as F

from exonloom.operators import graph as G
from exonloom.scale import Slabs


def test_many_small_keys_take_the_plain_window(spark):
    spark.conf.set("spark.exonloom.smallRows", "10")
    try:
        rows = spark.range(1000).selectExpr("id % 200 as k", "id")
        many = Slabs(rows, ["k"], ["id"]).scan(("n", "sum", F.lit(1), True))
        hot = Slabs(rows.withColumn("k", F.lit(0)), ["k"], ["id"])
        assert many.single and not hot.single
        assert many.result().where("n = 5").count() == 200
    finally:
        spark.conf.unset("spark.exonloom.smallRows")


def test_lone_runs_stay_out_of_the_graph(spark, monkeypatch):
    seen, whole = [], G.components
    monkeypatch.setattr(G, "components", lambda edges: seen.append(edges.count()) or whole(edges))
    apart = spark.range(500).selectExpr("'c' as contig", "id * 100 as start", "id * 100 + 20 + id % 30 as end")
    got = G.group_loci(apart)
    assert got.count() == got.select("locus").distinct().count() == 500
    assert seen == [0]
