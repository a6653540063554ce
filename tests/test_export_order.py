"""Sequences of several lists come out of one join; sorted files hold the lines in order, whatever the partitions."""

import glob
import random

from pyspark.sql import functions as F

from exonloom.operators import models as M
from exonloom.operators import sequences as Q
from exonloom.sinks import text as K

SPANS = "array<struct<start:bigint,end:bigint>>"


def test_several_lists_of_spans(spark):
    rnd = random.Random(4)
    seqs = {"c1": "".join(rnd.choice("ACGTacgt") for _ in range(990)), "c2": "".join(rnd.choice("ACGTé") for _ in range(130)), "c3": ""}
    spans = lambda n, m: [(a := rnd.randrange(1, n), a + rnd.randrange(0, m)) for _ in range(rnd.randrange(0, 5))]
    rows = [(f"t{i}", rnd.choice(["c1", "c2", "c3", "gone"]), spans(1000, 90), spans(140, 30)) for i in range(200)] + [("none", "c1", None, [(5, 7)]), ("both", "c1", None, None), ("far", "c1", [(3, 400)], None)]
    got = Q.splice_lists(spark.createDataFrame(rows, f"tx_id string, contig string, exons {SPANS}, cds {SPANS}"), spark.createDataFrame(list(seqs.items()), "seq_id string, seq string"), {"exons": "long", "cds": "short"}, 64)
    cut = lambda c, some: "".join(seqs.get(c, "")[a - 1:b] for a, b in sorted(some or []))
    assert sorted((r["tx_id"], r["long"], r["short"]) for r in got.collect()) == sorted((t, cut(c, x), cut(c, y)) for t, c, x, y in rows)


def test_only_unknown_phases_are_translated_in_three_frames(spark):
    seqs = spark.createDataFrame([("c", "ATGTAACCCTGA" * 5)], "seq_id string, seq string")
    rows = [("a", "+", 1, [(1, 60)]), ("b", "+", None, [(1, 60)]), ("c", "-", 3, [(1, 60)]), ("d", "-", None, [(2, 60)])]
    df = spark.createDataFrame([(t, "c", s, "mRNA", c, x, x) for t, s, c, x in rows], f"tx_id string, contig string, strand string, type string, codon_start int, exons {SPANS}, cds {SPANS}")
    got = {r["tx_id"]: r for r in M.add_sequences(df, seqs).collect()}
    assert got["a"]["codon_start"] == 1 and got["a"]["protein"] == "M*P*" * 5 and got["c"]["codon_start"] == 3
    # frame 2 of the first reads TGT AAC CCT GAA, without a stop
    assert got["b"]["codon_start"] == 2 and got["b"]["protein"].startswith("CNPE") and got["d"]["codon_start"] in (1, 2, 3)


def test_sorted_files_hold_the_lines_in_order(spark, tmpdir_spark):
    rnd = random.Random(6)
    spans = [(100 * i, 100 * i + 50) for i in range(1, 4)]
    rows = [(f"g{i}", f"g{i}-T{k}", rnd.choice(["c10", "c9", "c2"]), rnd.choice("+-"), rnd.randrange(5), "mRNA", spans, spans, "ATG" * k) for i in range(150) for k in (1, 2)]
    df = spark.createDataFrame(rows, f"gene_id string, tx_id string, contig string, strand string, gene_start long, type string, exons {SPANS}, cds {SPANS}, seq string").repartition(8)
    none = {c: F.array().cast("array<string>") for c in ("synonyms", "go", "dbxrefs", "ec", "notes")}
    df = df.withColumns({"source": F.lit("s"), "name": F.lit(None).cast("string"), "product": F.lit("p"), "gene_end": F.lit(900).cast("long"), "codon_start": F.lit(1), "pseudo": F.lit(False), "partial_start": F.lit(False), "partial_stop": F.lit(True), **none})
    read = lambda name: [x for f in sorted(glob.glob(f"{tmpdir_spark}/{name}/part-*")) for x in open(f).read().splitlines()]
    place = lambda r: (int(r["contig"][1:]), r["gene_start"], r["gene_id"], r["tx_id"], r["ord"])
    K.write_gff3(df, f"{tmpdir_spark}/gff3")
    assert read("gff3") == ["##gff-version 3"] + [r["line"] for r in sorted(K.gff3_lines(df).collect(), key=place)]
    K.write_gtf(df, f"{tmpdir_spark}/gtf")
    assert read("gtf") == [r["line"] for r in sorted(K.gtf_lines(df).collect(), key=place)]
    K.write_fasta(df.select("tx_id", "seq"), f"{tmpdir_spark}/fasta", ["tx_id"], header="tx_id")
    assert read("fasta") == [x for r in sorted(rows, key=lambda r: r[1]) for x in (">" + r[1], r[8])]
