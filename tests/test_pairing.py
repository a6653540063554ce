"""Pairing of CDS and exon lists."""

from exonloom.operators import models as M

CDS = "gene_id string, cds_no int, cds array<struct<start: long, `end`: long>>"
EXONS = "gene_id string, exon_no int, exons array<struct<start: long, `end`: long>>"


def test_clear_pairs_need_no_assignment(spark, monkeypatch):
    cds = spark.createDataFrame([("g", i, [(100 * i + 10, 100 * i + 50)]) for i in (1, 2, 3)], CDS)
    # each reversed list touches the other places without covering them
    exons = spark.createDataFrame([("g", 4 - i, sorted([(100 * i, 100 * i + 90)] + [(100 * j, 100 * j + 30) for j in (1, 2, 3) if j != i])) for i in (1, 2, 3)], EXONS)

    def raise_on_rows(batches):
        for b in batches:
            if b.num_rows:
                raise RuntimeError("a settled gene reached the assignment")
            yield b

    monkeypatch.setattr(M, "_assign_genes", raise_on_rows)
    assert sorted(map(tuple, M.pair_cds_exons(cds, exons).collect())) == [("g", 1, 3), ("g", 2, 2), ("g", 3, 1)]


def test_choices_are_assigned_in_order(spark):
    cds = spark.createDataFrame([("g", 1, [(10, 50)]), ("g", 2, [(10, 90)]), ("h", 1, [(10, 50)]), ("h", 2, [(10, 90)])], CDS)
    exons = spark.createDataFrame([("g", 1, [(5, 95)]), ("g", 2, [(5, 60)]), ("h", 7, [(5, 60)]), ("h", 8, [(5, 60)])], EXONS)
    assert sorted(map(tuple, M.pair_cds_exons(cds, exons).collect()), key=str) == [("g", 1, 2), ("g", 2, 1), ("h", 1, None), ("h", 2, None)]
