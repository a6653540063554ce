"""Genes of a cluster report are read from their records once."""

from exonloom.sources import blocks as B

TABLE = "     CDS             10..40\n                     /locus_tag=\"g1\"\n                     /NRPS_PKS=\"type: t1pks\"\n                     /NRPS_PKS=\"Domain: KS. x\""


def test_genes_without_a_join(spark):
    made = B.antismash_genes(spark.createDataFrame([("r.1", TABLE, 6), ("r.2", TABLE.replace("g1", "g2"), None)], "record string, table string, smash_version int"))
    assert {(r["gene_id"], r["backbone"], r["domains"]) for r in made.collect()} == {("g1", "t1pks", "KS"), ("g2", "t1pks", "KS")}
    assert "Join" not in made._jdf.queryExecution().executedPlan().toString()
