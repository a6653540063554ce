import __spark_entry__ as E
import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from exonloom.scale import materialize

from brute import prose, quality_counts, shingles

FOLDER = "/root/testdata/sf0.001"


def test_contract(spark):
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_copies", "repeated_passages", "source_mix", "packing"]
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in E.queries()) == 1
    assert "pipeline" in E.queries()


def test_stages_take_effect(spark, make_docs, odd_rows):
    rng = np.random.default_rng(12)
    clean = prose(rng, 200, 10**6)
    passage = prose(rng, 60, 10**6)
    rows = list(odd_rows) + [(201, clean, "a"), (202, clean + " end", "a"), (203, "$$$ ### " * 200, "b"), (204, prose(rng, 80, 10**6) + "\n" + passage, "b"), (205, passage + "\n" + prose(rng, 80, 10**6), "c")]
    docs = make_docs(rows)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        docs = materialize(out, "stage")
        seen[name] = docs.toPandas()
    kept = {k: set(v.doc_id.dropna().astype(int)) for k, v in seen.items()}
    assert 203 not in kept["quality_rules"] and {201, 202, 204, 205} <= kept["quality_rules"]
    for t in seen["quality_rules"].text:
        n = quality_counts(t)
        assert n[0] >= 10 and 100 * n[4] <= 20 * n[0]
    assert 201 in kept["near_copies"] and 202 not in kept["near_copies"]
    sets = [shingles(t) for t in seen["near_copies"].text]
    assert not any(len(a & b) >= 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    texts = dict(zip(seen["repeated_passages"].doc_id, seen["repeated_passages"].text))
    assert passage in texts[204] and passage not in texts[205] and len(texts[205].split()) == 80
    assert (seen["repeated_passages"].text.str.len() == seen["repeated_passages"].n_chars).all()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).toPandas()
    assert last.groupby("sequence_id").length.sum().max() <= 2048


def test_empty_documents(spark, make_docs):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0
        docs = docs if "text" not in out.columns else spark.createDataFrame([], out.schema)


def test_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.agg(F.sum("length")).first()[0] > 0
