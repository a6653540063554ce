"""Gene models come out of one grouping of the features: what is written holds ids, not feature rows."""

from pyspark.sql import functions as F

from exonloom.operators import models as M
from exonloom.sinks import text as K
from exonloom.sources import lines as L

ROWS = [
    ("gene", 1, 900, "+", ".", "ID=g1;Name=nm1;Alias=s2,s1"), ("mRNA", 1, 900, "+", ".", "ID=t1;Parent=g1;product=a%20b;Note=x,y;EC_number=1.1.1.1"), ("mRNA", 5, 800, "+", ".", "ID=t2;Parent=g1"),
    ("exon", 300, 400, "+", ".", "ID=e2;Parent=t1"), ("exon", 1, 100, "+", ".", "ID=e1;Parent=t1,t2"), ("CDS", 300, 390, "+", "2", "ID=c;Parent=t1"), ("CDS", 10, 100, "+", "1", "ID=c;Parent=t1,t2"),
    ("five_prime_UTR", 1, 9, "+", ".", "ID=u;Parent=t1"), ("exon", 1, 2, "+", ".", "ID=lost;Parent=g1"), ("exon", 1, 2, "+", ".", "ID=none"),
    ("gene", 1, 50, "-", ".", "ID=bad"), ("mRNA", 1, 50, "-", ".", "ID=b1;Parent=bad"), ("exon", 1, 50, "-", ".", "ID=x;Parent=b1"), ("mRNA", 1, 50, "-", ".", "ID=b2;Parent=bad"), ("CDS", 1, 50, "-", "0", "ID=x;Parent=b2"),
    ("pseudogene", 60, 90, "-", ".", "ID=g3"), ("tRNA", 60, 80, "-", ".", "Parent=g3"), ("tRNA", 70, 90, "-", ".", "Parent=g3"), ("tRNA", 1, 9, "-", ".", "ID=alone"),
    ("transcript", 60, 90, "-", ".", "ID=t4;Parent=g3;gbkey=misc_RNA"), ("CDS", 65, 80, "-", ".", "ID=x;Parent=t4"), ("gene", 7, 8, "+", ".", "Name=nameless")]


def test_gene_models_read_the_features_once(spark, monkeypatch):
    written = []
    true = M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name="t": written.append(true(df, name)) or written[-1])
    text = ["#c", "short\tline"] + ["\t".join(["c1", "src", k, str(a), str(b), ".", st, ph, at]) for k, a, b, st, ph, at in ROWS]
    rows = M.gene_models(L.parse_gff3(spark.createDataFrame([(x,) for x in text], "value string"))).orderBy("gene_id", "gene_start", "tx_id", "exons").collect()
    spans = lambda x: [tuple(e) for e in x]
    got = [(r["gene_id"], r["tx_id"], r["type"], r["name"], r["product"], r["gene_start"], r["gene_end"], spans(r["exons"]), spans(r["cds"]), r["codon_start"], r["pseudo"]) for r in rows]
    assert got == [
        ("g1", "t1", "mRNA", "nm1", "a b", 1, 400, [(1, 100), (300, 400)], [(10, 100), (300, 390)], 2, False),
        ("g1", "t2", "mRNA", "nm1", "hypothetical protein", 1, 400, [(1, 100)], [(10, 100)], 2, False),
        ("g3", None, "tRNA", None, None, 60, 90, [], [], None, True), ("g3", None, "tRNA", None, None, 60, 90, [], [], None, True),
        ("g3", "t4", "ncRNA", None, None, 60, 90, [], [(65, 80)], None, True)]
    assert [(r["notes"], r["ec"], r["synonyms"]) for r in rows][:2] == [(["x", "y"], ["1.1.1.1"], ["s1", "s2"]), ([], [], ["s1", "s2"])]
    # g1, bad and g3, six transcripts with an id and two without, and ids that only parts name
    assert sum(df.count() for df in written) <= 11 < len(ROWS)


def test_lines_of_parts_and_of_models_without_exons(spark):
    """Phases run along many parts in both directions; a model without any list of exons keeps its gene line."""
    many = [(100 * i, 100 * i + 10 + i) for i in range(1, 120)]
    parts = "array<struct<start:bigint,end:bigint>>"
    df = spark.createDataFrame([("g1", "t1", "+", "mRNA", many, many), ("g2", "t2", "-", "mRNA", many, many), ("g3", "t3", "-", "tRNA", [(5, 9)], [])], f"gene_id string, tx_id string, strand string, type string, exons {parts}, cds {parts}")
    none = F.lit(None).cast("string")
    lists = {c: F.array().cast("array<string>") for c in ("synonyms", "go", "dbxrefs", "ec", "notes")}
    df = df.withColumns({"contig": F.lit("c"), "source": F.lit("s"), "name": none, "product": none, "gene_start": F.lit(1).cast("long"), "gene_end": F.lit(13000).cast("long"), "codon_start": F.lit(2), "pseudo": F.lit(False), **lists})
    got = {}
    for r in K.gff3_lines(df).orderBy("gene_id", "tx_id", "ord").collect():
        got.setdefault((r["tx_id"], r["line"].split("\t")[2]), []).append(r["line"].split("\t"))
    for tx, order in (("t1", many), ("t2", many[::-1])):
        at, want = 0, []
        for a, b in order:
            want.append((str(a), str(b), str((1 - at) % 3)))
            at += b - a + 1
        assert [(p[3], p[4], p[7]) for p in got[tx, "CDS"]] == want
        assert [p[8] for p in got[tx, "exon"]] == [f"ID={tx}.exon{i + 1};Parent={tx};" for i in range(len(many))]
    assert [p[3:5] for p in got["t3", "exon"]] == [["5", "9"]] and ("t3", "CDS") not in got
    assert got["t3", "tRNA"][0][8] == "ID=t3;Parent=g3;product=None;" and len([k for k in got if k[1] == "gene"]) == 1
