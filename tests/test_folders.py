"""Folders of contigs and blocks of submission tables."""

import os

from pyspark.sql import functions as F

from exonloom.plans.q_models import gene_table
from exonloom.plans.registry import Tables
from exonloom.operators import models as M
from exonloom.sinks import text as K
from exonloom.sources import blocks as B


def folders(path):
    return sorted(f for f in os.listdir(path) if f.startswith("seq_id="))


def test_short_contigs_share_a_folder(spark, tmp_path):
    df = spark.range(300).selectExpr("concat('c', id) as seq_id", "repeat('ACGTT', cast(if(id = 7, 500, id % 90) as int)) as seq")
    K.write_partitioned(df, str(tmp_path / "a"), size=400, own=1000)
    assert len(folders(tmp_path / "a")) == 2 and "seq_id=c7" in folders(tmp_path / "a")
    got = {r["seq_id"]: r["seq"] for r in B.read_fasta(spark, str(tmp_path / "a")).collect()}
    assert got == {r["seq_id"]: r["seq"] for r in df.collect()}
    K.write_partitioned(df.limit(20), str(tmp_path / "b"), own=0)
    assert len(folders(tmp_path / "b")) == 20


def test_blocks_of_a_submission_table_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "TBL_GENES", 10)
    m = M.order_transcripts(gene_table(Tables(spark, "/root/testdata/sf0.001"))).withColumn("contig", F.lit("ctg1"))
    K.write_tbl(m, spark.createDataFrame([("ctg1", "ACGT")], "seq_id string, seq string"), str(tmp_path / "t"))
    blocks = B.read_blocks(spark, str(tmp_path / "t"), "\n>Feature ")
    assert blocks.agg(F.max(F.size(F.split("value", "\tgene\n")))).first()[0] <= 11
    assert blocks.where("value like '%REFERENCE%'").count() == 1
    genes = B.read_tbl(spark, str(tmp_path / "t")).where("kind = 'gene' and contig = 'ctg1'")
    assert genes.select("gene_id").distinct().count() == m.select("gene_id").distinct().count()
