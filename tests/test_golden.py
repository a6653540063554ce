"""Documented rows and behaviours of single operators."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from exonloom.functions import codes
from exonloom.functions import naming as N
from exonloom.functions import sequence as S
from exonloom.operators import annotations as A
from exonloom.operators import models as M
from exonloom.plans import flows
from exonloom.sinks import text as K
from exonloom.sources import blocks as B
from exonloom.sources import lines as L


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()[0]


def text(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_translation_tables(spark):
    assert one(spark, S.translate(F.lit("ATGCTGTAA"))) == "ML*"
    assert one(spark, S.translate(F.lit("ATGCTGTAA"), 0, 12)) == "MS*"
    assert one(spark, S.translate(F.lit("atgnnnta"))) == "MX"
    assert len(codes.valid_tables()) == 27 and codes.codon_table(4)["TGA"] == "W"
    assert one(spark, S.revcomp(F.lit("acgtRU-N"))) == "NAYACGT"


def clean(spark, product, name="ABC1", curated=False):
    df = spark.createDataFrame([(product, name, curated)], "product string, name string, cur boolean")
    return N.add_clean_product(df, curated="cur").first()["clean"]


def test_product_rules(spark):
    assert clean(spark, "probable sugar transporter") == "putative sugar transporter"
    assert clean(spark, "Homolog to Saccharomyces cerevisiae gpr1") == "Protein gpr1"
    assert clean(spark, "conserved domain-containing factor") == "conserved domain-containing factor"
    assert clean(spark, "homologous recombination factor") == "homologous recombination factor"
    assert clean(spark, "serine kinase (fragment") == "serine kinase"
    assert clean(spark, "DNA ligase protein") == "DNA ligase"
    assert clean(spark, "binds Sin3p in two-hybrid assay") == "Abc1p"
    assert clean(spark, "binds Sin3p in two-hybrid assay", curated=True) == "binds Sin3p in two-hybrid assay"
    assert clean(spark, "x" * 101) == "Abc1p"
    assert clean(spark, "myosin type II ABC1") == "myosin type 2 abc1"


def test_symbols(spark):
    ok = [s for s in ["ABC1", "AB", "ABC", "A_B1", "ABC.1", "AB123", "AB12"] if one(spark, N.valid_symbol(F.lit(s)))]
    assert ok == ["ABC1", "AB12"]
    d = F.lit("Valid protein OS=Example species GN=ABC1")
    assert one(spark, N.swissprot_symbol(d)) == "ABC1" and one(spark, N.swissprot_product(d)) == "Valid protein"
    assert [one(spark, N.valid_ec(F.lit(e))) for e in ("1.1.1.1", "1.6", "1.2.3.n", "3.2.1.-")] == [True, False, True, True]
    assert one(spark, N.common_ec_prefix(F.lit("1.2.3.4,1.2.3.5"))) == "1.2.3"


def test_secretome(spark):
    ph = L.parse_phobius(text(spark, ["ID\tTM\tSP\tPrediction", "V1\t0\t0\to", "V2\t2\t0\ti198-219o283-301i", "V4\t0\tY\tn8-18c23/24o"]))
    got = sorted(tuple(r) for r in A.merge_secretome(ph, None).collect())
    assert got == [("V2", "note", "TransMembrane:2 (i198-219o283-301i)"), ("V4", "note", "SECRETED:SignalP(1-23)")]
    v4 = text(spark, ["# SignalP-4.1 euk", "g1 0.1 22 0.1 22 0.2 11 0.1 0.9 Y 0.9 0.45 x"])
    assert L.parse_signalp(v4, 4).collect()[0]["end"] == "21"
    v6 = text(spark, ["# SignalP-6.0", "g2 desc\tSP\t0.9\t0.1\tCS pos: 19-20. Pr: 0.97", "g3\tOTHER\t1\t0\t"])
    rows = L.parse_signalp(v6, L.signalp_version(v6)).collect()
    assert [(r["id"], r["end"], r["prob"]) for r in rows] == [("g2", "19", "0.97")]


def test_eggnog_layouts(spark):
    v1 = "#query_name\tseed\te\ts\tpredicted_gene_name\tGO_terms\tKEGG\tBiGG\tAnnotation_tax_scope\tOGs\tbestOG\tCOG cat\teggNOG annot"
    df = text(spark, [v1, "g1\tx\t0\t1\tABC1\t\t\t\tfuNOG[21]\tA@fuNOG\tb\tK\tText"])
    r = L.parse_eggnog(df, L.header_of(df, "#query")).first()
    assert (r["query"], r["tax"], r["ogs"], r["cogs"], r["description"]) == ("g1", "fuNOG[21]", "A@fuNOG", "K", "Text")
    assert L.parse_eggnog(df, None).first()["symbol"] == "ABC1"


def test_protein_hints(spark):
    al = spark.createDataFrame([("c1", "+", "p1", [(100, 200), (300, 400)])], "contig string, strand string, target string, exons array<struct<start:bigint,end:bigint>>")
    got = sorted((r["feature"], r["start"], r["end"]) for r in M.protein_hints(al).collect())
    assert got == [("CDSpart", 115, 185), ("CDSpart", 315, 385), ("intron", 201, 299)]


def test_fasta_and_fastq_files(spark, tmpdir_spark):
    p = os.path.join(tmpdir_spark, "a.fa.gz")
    with gzip.open(p, "wt") as f:
        f.write(">s1 first one\nACGT\nAC\n>s2\nGGnn\n")
    assert sorted(map(tuple, B.read_fasta(spark, p).collect())) == [("s1", "first one", "ACGTAC"), ("s2", "", "GGnn")]
    q = os.path.join(tmpdir_spark, "r.fastq")
    with open(q, "w") as f:
        for i in range(5000):
            f.write(f"@r{i}/1 x\nACGTA\n+\n@@@@@\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        reads = B.read_fastq(spark, q)
        assert reads.where("qual = '@@@@@' and seq = 'ACGTA'").select("title").distinct().count() == 5000
        assert B.fastq_to_fasta(reads).where("startswith(seq_id, 'r7_1')").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


GFF = """##gff-version 3
c1\tx\tgene\t1\t30\t.\t+\t.\tID=g1;Name=N1;Alias=a,b;
c1\tx\tmRNA\t1\t30\t.\t+\t.\tID=g1-T1;Parent=g1;product=some%20kinase;
c1\tx\texon\t1\t12\t.\t+\t.\tID=e1;Parent=g1-T1;
c1\tx\texon\t16\t30\t.\t+\t.\tID=e2;Parent=g1-T1;
c1\tx\tCDS\t1\t12\t.\t+\t0\tID=c;Parent=g1-T1;
c1\tx\tCDS\t16\t24\t.\t+\t0\tID=c;Parent=g1-T1;
c1\tx\tgene\t5\t9\t.\t-\t.\tID=g2;
c1\tx\tmRNA\t5\t9\t.\t-\t.\tID=g2-T1;Parent=g2;
c1\tx\texon\t5\t9\t.\t-\t.\tID=e3;Parent=g2-T1;
zz\tx\tgene\t5\t9\t.\t-\t.\tID=g3;""".split("\n")


def test_gene_models_from_gff(spark, tmpdir_spark):
    seqs = spark.createDataFrame([("c1", "ATGAAACTGTTTNNNCTGCTGTAAGGGGGG")], "seq_id string, seq string")
    m = M.add_sequences(M.gene_models(L.parse_gff3(text(spark, GFF)), seqs), seqs)
    rows = m.collect()
    assert [r["gene_id"] for r in rows] == ["g1"]        # g2 has no CDS, g3 sits on an unknown contig
    r = rows[0]
    assert r["protein"] == "MKLFLL*" and not r["partial_start"] and not r["partial_stop"]
    assert r["product"] == "some kinase" and r["codon_start"] == 1
    out = os.path.join(tmpdir_spark, "out")
    ranked = M.order_transcripts(m.withColumn("tpm", F.lit(1.0)).withColumn("tx_ord", F.lit(1)))
    K.export_all(ranked, seqs, out)
    terms = spark.createDataFrame([("GO:0006508", "proteolysis", "biological_process", ["GO:1"])], "go_id string, name string, namespace string, alt_ids array<string>")
    block = K.tbl_blocks(K.with_go_lines(ranked.withColumn("go", F.array(F.lit("GO:0006508"))), terms)).first()["line"]
    assert "\t\t\tgo_process\tproteolysis|0006508||IEA\n" in block and "\t\t\tgene_synonym\ta\n" in block and block.startswith("1\t30\tgene\n\t\t\tgene\tN1\n")
    tbl = B.read_tbl(spark, out + "/tbl").where("kind = 'CDS'").first()
    assert [tuple(p) for p in tbl["parts"]] == [(1, 12), (16, 24)] and tbl["tx_id"] == "g1-T1"
    again = M.gene_models(L.read_gff3(spark, out + "/gff3")).first()
    assert [tuple(e) for e in again["exons"]] == [(1, 12), (16, 30)]
    assert B.read_fasta(spark, out + "/proteins").first()["seq"] == "MKLFLL"


def test_unknown_phase_takes_best_frame(spark):
    # frame 1 has an inner TGA, the TGA of frame 2 closes it
    assert one(spark, S.best_frame(F.lit("TGAAAAATGAC"), F.lit("+"))["frame"]) == 2


def test_flows(spark):
    seqs = spark.createDataFrame([("c1", "ATG" + "AAA" * 80 + "TAA" + "G" * 60)], "seq_id string, seq string")
    models = spark.createDataFrame(
        [("a", "a-T1", "pasa", 1, 246), ("b", "b-T1", "snap", 1, 246), ("c", "c-T1", "snap", 4, 246)], "gene_id string, tx_id string, source string, gene_start long, gene_end long")
    span = F.array(F.struct(F.col("gene_start").alias("start"), F.col("gene_end").alias("end")))
    models = models.withColumn("contig", F.lit("c1")).withColumn("strand", F.lit("+")).withColumn("type", F.lit("mRNA")).withColumn("exons", span).withColumn("cds", span).withColumn("codon_start", F.lit(1))
    none = spark.createDataFrame([], "contig string, start long, end long")
    trna = spark.createDataFrame([("c1", 250, 300), ("c1", 100, 160)], "contig string, start long, end long")
    out = flows.predict(models, none, seqs, none, spark.createDataFrame([], "gene_id string"), trna)
    got = out["models"].collect()
    assert [r["gene_id"] for r in got] == ["GENE_000001"] and got[0]["protein"].startswith("MKK")
    assert [(r["start"], r["end"]) for r in out["trnas"].collect()] == [(250, 300)]
    src = spark.createDataFrame([("G_1-T1", "name", "ABC1"), ("G_1-T1", "note", "COG:K,L"), ("G_1-T1", "EC_number", "1.1.1.1"), ("X_1", "note", "a")], "id string, ref_db string, value string")
    custom = spark.createDataFrame([("G_1", "name", "XYZ1", 1)], "id string, ref_db string, value string, ord int")
    ann = flows.annotate([src, src], ["G_"], custom)
    assert sorted((r["ref_db"], r["value"]) for r in ann["annotations"].collect()) == [
        ("EC_number", "1.1.1.1"), ("gene_synonym", "ABC1"), ("name", "XYZ1"), ("note", "COG:K,L")]
    assert sorted(r["hit"] for r in ann["channels"].where("channel = 'COG'").collect()) == ["K", "L"]


def test_start_and_stop_codons():
    assert codes.stop_codons(1) == {"TAA", "TAG", "TGA"} and codes.start_codons(1) == {"TTG", "CTG", "ATG"}
    assert codes.stop_codons(6) == {"TGA"} and codes.stop_codons(12) == {"TAA", "TAG", "TGA"} and codes.stop_codons(2) == {"TAA", "TAG", "AGA", "AGG"}
    assert codes.start_codons(12) == {"CTG", "ATG"} and set(codes.STARTS) == set(codes.valid_tables())
    for bad in (codes.stop_codons, codes.start_codons):
        with pytest.raises(ValueError):
            bad(7)


def test_weights_and_model_files():
    weights, unknown = M.parse_weights(["Augustus:3", "nobody:2", "snap"])
    assert weights["augustus"] == 3 and weights["snap"] == 1 and unknown == ["nobody"]
    assert M.parse_model_files(["a.gff3:5", "s3://x/b.gff3"]) == [("a.gff3", "other_pred1", 5), ("s3://x/b.gff3", "other_pred2", 1)]


def test_codes_equal_published_lines():
    # Published amino acid lines of NCBI tables in TCAG order.
    lines = {
        1: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
        2: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG",
        3: "FFLLSSSSYY**CCWWTTTTPPPPHHQQRRRRIIMMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
        4: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
        5: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSSSVVVVAAAADDEEGGGG",
        6: "FFLLSSSSYYQQCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
        9: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNNKSSSSVVVVAAAADDEEGGGG",
        10: "FFLLSSSSYY**CCCWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
        11: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
        12: "FFLLSSSSYY**CC*WLLLSPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
        13: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSGGVVVVAAAADDEEGGGG",
        26: "FFLLSSSSYY**CC*WLLLAPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    }
    for table, line in lines.items():
        own = codes.codon_table(table)
        assert "".join(own[a + b + c] for a in "TCAG" for b in "TCAG" for c in "TCAG") == line
