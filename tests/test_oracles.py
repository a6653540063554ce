"""Registered queries against their SQL twins on the smallest tables.

A representative part runs by default; EXONLOOM_FULL=1 runs all of them.
"""

import os

import pytest

import __spark_entry__ as E
from harness import duck, rows_of_duck, rows_of_spark

FOLDER = "/root/testdata/sf0.001"
DEFAULT = """j1_overlap_join j2_overlap_semi j2_overlap_anti j3_overlap_fraction j4_closest_join j5_best_overlap_join j6_drop_contained a25_merge_intervals w2_islands
 w11_partition_loci w14_renumber_clusters f1_revcomp f2_translate f5_splice f8_mask_intervals f9_split_at_gaps a2_nx a3_n50_weighted o4_best_hit o5_top_hits p7_filter_homologs
 o8_resolve_busco f18_clean_product a16_collect_annotations u6_apply_custom w7_suffix_duplicates p19_route_notes a14_braycurtis a20_ortholog_groups a28_gene_aed j9_diff_by_overlap
 a19_components s4_gene_models s7_read_tbl s8_genbank_features s2_read_fastq f10_expand_cs k4_tbl_blocks u12_consensus_models""".split()
NAMES = sorted(E.oracle_sql()) if os.environ.get("EXONLOOM_FULL") else DEFAULT


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    cols, rows = rows_of_spark(E.queries()[name](spark, FOLDER))
    dcols, drows = rows_of_duck(con, E.oracle_sql()[name])
    assert cols == dcols
    assert rows == drows
    assert rows


def test_contract(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    assert E.entry(spark).limit(1).count() == 1
