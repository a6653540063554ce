"""FASTA in pieces: contigs over many file splits, blocks and part files."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from exonloom.operators import sequences as Q
from exonloom.sinks import text as K
from exonloom.sources import blocks as B
from exonloom.sources.pieces import read_fasta_pieces


def records(rng):
    out = {}
    for i, n in enumerate([0, 1, 59, 60, 61, 5000, 90_000, 0, 777]):
        out[f"c{i}"] = "".join(rng.choice(list("ACGTacgtN"), n))
    return out


@pytest.mark.parametrize("split", [2000, 10**7])
@pytest.mark.parametrize("size", [64, 1000, Q.PIECE])
def test_read_in_pieces(spark, tmp_path, size, split):
    want = records(np.random.default_rng(3))
    for name, ids in (("a.fa", ["c0", "c1", "c2", "c6", "c3"]), ("b.fa", ["c4", "c5", "c7", "c8"])):
        with open(tmp_path / name, "w", newline="") as f:
            f.write("not in a record\n" if name == "b.fa" else "")
            for i in ids:
                f.write(f">{i} some text\r\n" if i == "c3" else f">{i}\n" if i == "c4" else f">{i} some text\n")
                f.write("".join(want[i][k:k + 60] + "\n" for k in range(0, len(want[i]), 60)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {}
        for r in read_fasta_pieces(spark, str(tmp_path), size).collect():
            assert r["offset"] == r["piece"] * size and len(r["chunk"]) <= size and r["description"] == ("" if r["seq_id"] == "c4" else "some text")
            assert got.setdefault(r["seq_id"], {}).setdefault(r["piece"], r["chunk"]) == r["chunk"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {i: "".join(p[k] for k in range(len(p))) for i, p in got.items()} == want
    assert all(len(p[k]) == size for p in got.values() for k in range(len(p) - 1))


def test_long_contig_is_never_one_row(spark, tmp_path):
    """3 Mb of one contig: no row above 70 kB on reading, masking, splicing and writing, and many part files."""
    rng = np.random.default_rng(1)
    seq = "".join(rng.choice(list("ACGTacgt"), 3_000_000))
    seq = seq[:1_400_000] + "N" * 200_000 + seq[1_600_000:]
    with open(tmp_path / "long.fa", "w") as f:
        f.write(">chr1\n" + "".join(seq[k:k + 60] + "\n" for k in range(0, len(seq), 60)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        pieces = read_fasta_pieces(spark, str(tmp_path / "long.fa"))
        from exonloom.scale import materialize
        pieces = materialize(pieces, "pieces")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert pieces.agg(F.max(F.length("chunk"))).first()[0] == Q.PIECE and pieces.count() == -(-len(seq) // Q.PIECE)
    assert Q.lengths(pieces).first()["length"] == len(seq)
    parts = sorted((r["start"], r["end"], r["kind"]) for r in Q.split_at_gaps(pieces, 10).collect())
    assert parts == [(1, 1_400_000, "W"), (1_400_001, 1_600_000, "N"), (1_600_001, 3_000_000, "W")]
    masked = Q.mask_fraction(pieces).first()
    assert (masked["masked"], masked["total"]) == (sum(c.islower() for c in seq), len(seq))
    spans = [(65_500, 65_600), (131_000, 131_080), (2_999_900, 3_000_000)]
    tx = spark.createDataFrame([("t", "chr1", [tuple(s) for s in spans])], "tx_id string, contig string, exons array<struct<start: long, `end`: long>>")
    assert Q.splice(tx, pieces).first()["spliced"] == "".join(seq[a - 1:b] for a, b in spans)
    for write, out in ((K.write_fasta_blocks, "flat"), (K.write_partitioned, "each")):
        write(pieces, str(tmp_path / out))
        folder = tmp_path / out / ("seq_id=chr1" if out == "each" else "")
        files = sorted(f for f in os.listdir(folder) if f.startswith("part-") and os.path.getsize(folder / f))
        assert len(files) > 1
        text = "".join((folder / f).read_text() for f in files)
        assert text == ">chr1\n" + "".join(seq[k:k + 80] + "\n" for k in range(0, len(seq), 80))


def test_blocks_of_whole_sequences(spark, tmp_path):
    want = records(np.random.default_rng(4))
    df = spark.createDataFrame(list(want.items()), "seq_id string, seq string")
    K.write_fasta_blocks(df, str(tmp_path / "x"), width=70, size=150)
    assert {r["seq_id"]: r["seq"] for r in B.read_fasta(spark, str(tmp_path / "x")).collect()}["c1"] == want["c1"]
    got = {}
    for r in sorted(read_fasta_pieces(spark, str(tmp_path / "x"), 500).collect(), key=lambda r: r["piece"]):
        got[r["seq_id"]] = got.get(r["seq_id"], "") + r["chunk"]
    assert got == want
