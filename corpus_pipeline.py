"""Corpus pipeline over ``documents``: each stage's table is written and read by the next.

Documents of bad quality go, one document of each group of near copies stays, passages that an
earlier document holds are cut out, sources are mixed to their target weights, and what is left
is packed into sequences. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exonloom.llm import mixing, near, quality, spans
from exonloom.llm.common import count_words, seal
from exonloom.llm.queries import packed
from exonloom.scale import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the trees reject (operator 5), trained on ``labels``."""
    forest = quality.train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    own, restore = seal(docs, "text")
    return restore(quality.judge(own, forest).where("kept"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least ``doc_id`` of each class of near copies (operator 3)."""
    return near.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of earlier documents (operator 10); a text that was all repeat goes."""
    own, restore = seal(docs, "doc_id", "text", "n_chars")
    cut = spans.remove_repeats(own, tidy=False)
    left = cut.where("n_removed = 0 or n_removed < n_words")
    left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return restore(left)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources by weight wants them (operator 8)."""
    own, restore = seal(docs, "doc_id", "text", "source")
    return restore(mixing.mix(own.withColumn("_size", count_words(own["text"])), size="_size", text="text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids with their place in a sequence (operator 2)."""
    return packed(docs.select("doc_id", "text"))


STAGES = [("quality_rules", keep_good), ("near_copies", one_of_near_copies), ("repeated_passages", cut_repeats), ("source_mix", mix_sources), ("packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
