"""The feature table ends where the old pattern ended it, and text written for the readers is packed."""

import glob
import os
import re

from exonloom.plans.q_readers import saved
from exonloom.sources import blocks as B

HEAD = "LOCUS       x\nACCESSION   x\nVERSION     x.2\nFEATURES             Location/Qualifiers\n"
GENE = '     gene            1..9\n                     /locus_tag="g1"\n     CDS             complement(join(1..3,5..9))\n                     /protein_id="ncbi:p1"\n                     /note="two\n                     lines"\n'


def test_table_ends_where_it_did(spark, tmpdir_spark):
    bodies = [GENE + "ORIGIN\n 1 acgt", GENE + "CONTIG      join(ABCD01.1)", GENE + "CONTIG      join(ABCD01.1)\nORIGIN\n 1 ac", GENE, GENE.rstrip("\n"), "ORIGIN\n 1 ac", GENE + "\nORIGIN\n 1 ac", ""]
    texts = [HEAD + b for b in bodies] + ["LOCUS       y\nORIGIN\nFEATURES\n" + GENE, "LOCUS       y\nno table", "LOCUS       z\nFEATURES without an end", "LOCUS       x\nCONTIG      a\nFEATURES  b\n" + GENE + "\nFEATURES c\n" + GENE + "ORIGIN\n"]
    old = re.compile(r"(?s)\nFEATURES[^\n]*\n(.*?)(?=\nORIGIN|\nCONTIG|\Z|\n\Z)")
    path = saved(spark.createDataFrame([(t + "\n//",) for t in texts], "value string").coalesce(1))
    got = [r["table"] for r in B.read_genbank(spark, path).collect()]
    # the last block of a file keeps its end mark
    want = [(m.group(1) if (m := old.search(t)) else "") for t in texts[:-1] + [texts[-1] + "\n//\n"]]
    assert sorted(got) == sorted(want)
    f = {r["kind"]: r for r in B.genbank_features(B.read_genbank(spark, path).limit(1)).collect()}
    assert f["CDS"]["id"] == "p1" and f["CDS"]["strand"] == "-" and [tuple(p) for p in f["CDS"]["parts"]] == [(1, 3), (5, 9)]
    assert [tuple(q) for q in f["CDS"]["quals"]] == [("protein_id", "ncbi:p1"), ("note", "two lines")] and f["gene"]["locus_tag"] == "g1"


def test_text_for_the_readers_is_packed(spark):
    text = HEAD + GENE + "ORIGIN\n//"
    path = saved(spark.createDataFrame([(text,)] * 4000, "value string"))
    assert sum(os.path.getsize(f) for f in glob.glob(path.split(":", 1)[-1] + "/part-*")) * 4 < 4000 * len(text)
    assert B.antismash_genes(B.read_genbank(spark, path)).where("gene_id = 'p1'").count() == 4000
