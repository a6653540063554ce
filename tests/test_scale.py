import pytest
from pyspark.sql import functions as F

from exonloom import scale
from exonloom.functions import sequence as S
from exonloom.operators import annotations as A
from exonloom.operators import intervals as I
from exonloom.operators import sequences as Q
from exonloom.sinks import text as K


def test_new_ids_do_not_repeat_beyond_the_width(spark):
    got = Q.rename_ids(spark.range(1_000_001), ["id"], "g_").agg(F.count_distinct("new_id"), F.max(F.length("new_id"))).first()
    assert tuple(got) == (1_000_001, 9)


def test_natural_order_of_long_numbers(spark):
    names = ["c2", "c10", "c123456789012345", "c1000000000000", "c10000000000001", "c0010x", "c9"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(S.natural_key(F.col("n")), "n").collect()]
    assert got == ["c2", "c9", "c10", "c0010x", "c1000000000000", "c10000000000001", "c123456789012345"]


def test_scratch_folder_must_be_shared_on_a_cluster():
    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(RuntimeError):
        scale.work_dir(Session)
    Session.conf = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"})
    assert scale.work_dir(Session) == "hdfs:///shared"


def test_scratch_tables_can_be_dropped(spark):
    df = scale.materialize(spark.range(10), "gone")
    assert df.count() == 10
    scale.drop_scratch(df)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0])


def test_a_contig_long_interval_meets_what_it_overlaps_only_once(spark):
    a = spark.range(20000).selectExpr("'c' as contig", "id * 50 as start", "id * 50 + if(id % 20 = 0, 5000, 20) as end", "id as name")
    b = a.where("name % 7 = 0").unionByName(spark.createDataFrame([("c", 1, 100_000_000, -1)], "contig string, start long, end long, name long"))
    left, right = [r[:] for r in a.collect()], [r[:] for r in b.collect()]
    want = sum(x[1] <= y[2] and x[2] >= y[1] for y in right[:60] for x in left)
    got = I.overlap_join(a, b)
    assert got.where("b_name = -1").count() == sum(x[2] >= 1 for x in left)
    ids = {y[3] for y in right[:60]}
    assert got.where(F.col("b_name").isin(list(ids))).count() == want
    assert got.count() == got.select("name", "b_name").distinct().count()


def test_pairs_looked_at_stay_near_pairs_returned(spark):
    """The ladder's bins, counted without the overlap test."""
    a = spark.range(20000).selectExpr("'c' as contig", "id * 50 as start", "id * 50 + if(id % 20 = 0, 5000, 20) as end")
    b = a.unionByName(spark.createDataFrame([("c", 1, 100_000_000)], "contig string, start long, end long")).select([F.col(c).alias(f"b_{c}") for c in a.columns])
    left, right = I._on_ladder(a, "start", "end", I._levels(b, "b_start", "b_end"), "_a"), I._on_ladder(b, "b_start", "b_end", I._levels(a, "start", "end"), "_b")
    met = left.join(right, (F.col("_abin") == F.col("_bbin")) & (F.col("_alevel") == F.col("_blevel")) & (F.col("_alevel") == F.greatest("_aown", "_bown"))).count()
    assert met < 20 * I.overlap_join(a, b.toDF("contig", "start", "end")).count()


def test_duplicate_names_are_numbered_in_natural_order(spark):
    names = spark.createDataFrame([("G10", "abc"), ("G2", "abc"), ("G1", "abc")], "id string, name string")
    assert {r["id"]: r["final_name"] for r in A.suffix_duplicates(names).collect()} == {"G1": "abc_1", "G2": "abc_2", "G10": "abc_3"}


def test_names_curated_in_lower_case_may_still_be_sentences(spark):
    c = spark.createDataFrame([("g1", 1, "ABC1", "some product")], "id string, ord int, name string, product string")
    cur = spark.createDataFrame([("abc1", "binds Sin3p in assay")], "name string, product string")
    assert A.name_products(c, cur).first()["product"] == "Abc1p"
    exact = spark.createDataFrame([("ABC1", "binds Sin3p in assay")], "name string, product string")
    assert A.name_products(c, exact).first()["product"] == "binds Sin3p in assay"


def test_contig_number_takes_all_digits(spark):
    g = spark.createDataFrame([("g", "scaffold_1.2", "+", 1, 9, None)], "gene_id string, contig string, strand string, start long, end long, product string")
    assert K.smurf_rows(g).first()["contig_no"] == "12"
